"""Order facts, customers and cohorts kept up to date from batches of changed raw rows.

A batch touches some orders and customers. Its raw rows are put beside those of earlier batches; of two copies the one that
counts is told when they are read. Only the buckets that hold touched orders and customers are read, only the touched orders
meet their items again, and only the buckets of touched customers are computed anew and written, each as a whole; what is
computed is what a full rebuild computes, by the same functions. All tables of a batch become visible in one step, when its
manifest is.

A batch may hold late rows and retries: a retry that replaces an order may give it another customer, and both count as
touched. Line items and their copies stay with their order.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.functions import clean_email, days_between, months_between
from subledger.operators import HotKeys, find_hot_keys, keep_first, left_join_few, number_rows
from subledger.plans import core, intermediate, reporting, staging
from subledger.session import materialized
from subledger.settings import Settings
from subledger.sources import raw_schema

_MANIFEST = "version long, batch string, name string, bucket int, folder string"
# Folders a bucket of raw rows may lie in before they are merged to one.
_MOST_FOLDERS = 8
# What is kept of a valid order, and which of it the facts do not publish; what the facts say of its customer.
_PLACED = [
    "order_id", "order_number", "shopify_customer_id", "customer_email", "order_created_at_utc", "gross_revenue",
    "discount_amount", "net_revenue", "tax_amount", "shipping_amount", "item_count", "total_units", "product_names", "skus",
    "is_subscription_order", "financial_status", "fulfillment_status", "discount_codes", "billing_state", "utm_source",
    "utm_medium", "channel",
]
_CARRIED = ["customer_email", "order_created_at_utc", "_copy"]
_ACQUIRED = ["acquisition_cohort_month", "acquisition_channel"]


class BucketStore:
    """Tables in hash buckets below ``root``, a folder every executor can write to.

    A version is a manifest: which folders hold which bucket of which table. It is one small file, moved to its place when
    it is complete, so readers see all of a version or nothing; folders are never written twice. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root, buckets
        self.version, self.batches, self.folders = 0, set(), {}

    def refresh(self) -> BucketStore:
        """Look for the latest manifest. Its rows are as many as there are buckets of tables."""
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/*").collect()
        self.version = max(r.version for r in rows)
        self.batches = {r.batch for r in rows}
        self.folders = {}
        for r in rows:
            if r.version == self.version and r.name:
                held = self.folders.setdefault(r.name, {})
                held[r.bucket] = (*held.get(r.bucket, ()), r.folder)
        return self

    def bucket(self, key: str | Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets of the keys in the only column: at most as many rows as there are buckets."""
        return sorted(r[0] for r in keys.select(self.bucket(keys.columns[0])).distinct().collect())

    def read(self, name: str, schema: T.StructType, buckets: Sequence[int] | None = None) -> DataFrame:
        """A table, or some of its buckets, as of the version that this store stands at. Others are not listed or opened."""
        held = self.folders.get(name, {})
        paths = [f"{folder}/_bucket={n}" for n in sorted(held) if buckets is None or n in buckets for folder in held[n]]
        if not paths:
            return nothing(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def folder(self, folder: str, schema: T.StructType) -> DataFrame:
        """The rows of one written folder."""
        return self.spark.read.schema(schema).parquet(folder).select(*schema.names)

    def write(self, name: str, df: DataFrame, key: str) -> str:
        """Write rows in buckets of ``key`` to a new folder. Large buckets are split among tasks, so a hot key is."""
        folder = f"{self.root}/data/{name}/{uuid.uuid4().hex}"
        df.withColumn("_bucket", self.bucket(key)).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(folder)
        return folder

    def commit(self, batch: str, written: Mapping[str, Sequence[tuple[str, Sequence[int]]]]) -> None:
        """Make a version in which each table has its new folders, in place of all that lay in the given buckets."""
        for name, parts in written.items():
            held = self.folders.setdefault(name, {})
            for folder, replaced in parts:
                for n in replaced:
                    held.pop(n, None)
                # Named by the listing; no file is opened.
                files = self.spark.read.schema("_bucket int").parquet(folder).inputFiles()
                for n in {int(f.split("/_bucket=")[1].split("/")[0]) for f in files}:
                    held[n] = (*held.get(n, ()), folder)
        self.version += 1
        self.batches.add(batch)
        rows = [(self.version, batch, "", -1, "")]
        rows += [(self.version, batch, name, n, f) for name, held in self.folders.items() for n, folders in held.items() for f in folders]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{self.root}/manifest/{self.version:09d}")


def nothing(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def among(df: DataFrame, column: str, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``column`` is (or, by ``left_anti``, is not) one of ``keys``; null is a key like any other."""
    known = keys.select(F.col(keys.columns[0]).alias("_key"))
    return df.join(known, F.col(column).eqNullSafe(F.col("_key")), how)


class IncrementalMarts:
    """``fct_orders``, ``dim_customers`` and cohort retention over a ``BucketStore``."""

    #: Raw tables: name here, system, published name, what their buckets go by.
    RAW = {
        "orders": ("shopify", "raw_shopify__orders", "id"),
        "items": ("shopify", "raw_shopify__order_line_items", "order_id"),
        "customers": ("shopify", "raw_shopify__customers", "_email"),
        "recharge": ("recharge", "raw_recharge__customers", "_email"),
        "subscriptions": ("recharge", "raw_recharge__subscriptions", "shopify_customer_id"),
    }

    def __init__(self, store: BucketStore, settings: Settings | None = None):
        self.store, self.spark, self.settings = store, store.spark, settings or Settings()

    def raw_schema(self, name: str) -> T.StructType:
        system, table, _ = self.RAW[name]
        return raw_schema(system, table)

    @cached_property
    def schemas(self) -> dict[str, T.StructType]:
        """Schemas of the derived tables, from the plans that fill them."""
        none = {name: nothing(self.spark, self.raw_schema(name)) for name in self.RAW}
        made = self._derived(none["orders"], none["items"], none["customers"], none["recharge"], none["subscriptions"])
        return {name: _nullable(df.schema) for name, df in made.items()} | {
            "cohorts": T.StructType.fromDDL("cohort_month date, months_since_first_order bigint, customers_active bigint")
        }

    def _derived(self, orders, items, customers, recharge, subscriptions) -> dict[str, DataFrame]:
        placed, unified = self._placed_orders(orders, self._items(items, orders)), self._unified(customers, recharge)
        facts = self._facts(placed, unified, HotKeys("shopify_customer_id"))
        return {"unified": unified, "fct_orders": facts, "dim_customers": self._dimension(facts, unified, staging.subscriptions(subscriptions, self.settings))}

    # What a full rebuild computes, on any subset of orders, e-mails or customers

    def _items(self, items: DataFrame, orders: DataFrame) -> DataFrame:
        """One raw row per line item of the given raw orders, chosen among the copies with its order: one shuffle by order
        serves the choice, the aggregate per order and its join. Items without an id are copies of one another whatever
        their order, so only the order of the one that stays keeps it.
        """
        unnamed = staging.first_items(items.filter("id is null")).select(F.col("order_id").alias("_kept_in"))
        wanted = orders.select(F.col("id").alias("_order"))
        chosen = keep_first(items.join(wanted, F.col("order_id") == F.col("_order"), "left_semi"), ["order_id", "id"], skip=["id"])
        told = chosen.join(F.broadcast(unnamed), F.col("order_id") == F.col("_kept_in"), "left")
        return told.filter("id is not null or _kept_in is not null").drop("_kept_in")

    def _placed_orders(self, orders: DataFrame, items: DataFrame) -> DataFrame:
        """Valid orders with what was in them, before their place in the customer's history. Of ``items`` copies are gone."""
        valid = intermediate.valid_orders(staging.shop_orders(orders, self.settings))
        return valid.join(intermediate.order_items(staging.line_item_columns(items)), "order_id", "left").select(*_PLACED)

    def _unified(self, customers: DataFrame, recharge: DataFrame) -> DataFrame:
        shop = staging.shop_customers(customers, self.settings)
        return intermediate.unified_customers(shop, staging.subscription_customers(recharge))

    def _facts(self, placed: DataFrame, unified: DataFrame, hot: HotKeys) -> DataFrame:
        """Order facts with what the next batch needs of them. An order has a row for every row that its customer has in the
        dimension; the first is number 0 in ``_copy``.
        """
        key = "shopify_customer_id"
        number = F.row_number().over(Window.partitionBy(key).orderBy("customer_email")) - 1
        known = unified.select(key, number.alias("_copy"))
        history = number_rows(placed, intermediate.HISTORY, "customer_order_sequence", hot)
        if hot:
            first = core.customer_orders(placed).select(key, *_ACQUIRED)
            orders = left_join_few(history, known.join(first, key, "left"), hot, spread=["order_id"])
        else:
            joined = intermediate.with_acquisition(history).join(known, key, "left")
            orders = joined.withColumns({c: F.when(F.col("_copy").isNotNull(), F.col(c)) for c in _ACQUIRED})
        orders = orders.withColumn("_copy", F.coalesce("_copy", F.lit(0)))
        return core.order_fact_columns(intermediate.enriched_orders(orders, *_ACQUIRED, "_copy"), *_CARRIED)

    def _dimension(self, facts: DataFrame, unified: DataFrame, subscriptions: DataFrame) -> DataFrame:
        return core.customers(unified, _placed(facts), subscriptions, self.settings)

    # A batch

    def apply(self, batch: str, **changed: DataFrame) -> None:
        """Take in changed raw rows by the names of ``RAW``; missing tables have none. A batch that was applied before is
        passed over, so a job that failed anywhere can be run again."""
        if batch in self.store.batches:
            return
        store, written = self.store, {}
        raw_schemas = {name: _keyed_schema(self.raw_schema(name), key) for name, (_, _, key) in self.RAW.items()}

        def append(name: str) -> DataFrame:
            """The new raw rows, written beside the old ones. Buckets in many folders are merged first."""
            if name not in changed:
                return nothing(self.spark, raw_schemas[name])
            key, parts = self.RAW[name][2], []
            full = [n for n, folders in store.folders.get(name, {}).items() if len(folders) >= _MOST_FOLDERS]
            if full:
                parts.append((store.write(name, _survivors(name, store.read(name, raw_schemas[name], full)), key), full))
            folder = store.write(name, _keyed(changed[name].select(*self.raw_schema(name).names), key), key)
            written[name] = [*parts, (folder, [])]
            return store.folder(folder, raw_schemas[name])

        def replace(name: str, schema: T.StructType, buckets: Sequence[int], df: DataFrame, key: str) -> DataFrame:
            """``df`` in place of these buckets; the written rows. Nothing is written if there are none to replace."""
            if not buckets:
                return nothing(self.spark, schema)
            folder = store.write(name, df, key)
            written[name] = [(folder, buckets)]
            return store.folder(folder, schema)

        rows = {name: append(name) for name in self.RAW}
        orders = materialized(rows["orders"].select("id").union(rows["items"].select("order_id")).distinct())
        emails = materialized(rows["customers"].select("_email").union(rows["recharge"].select("_email")).distinct())
        # An order and its items, and either side of the customers' join, whichever of them changed.
        by_order, by_email = store.touched(orders), store.touched(emails)
        old = lambda name, buckets: store.read(name, raw_schemas[name], buckets).select(*raw_schemas[name].names)
        both = lambda name, buckets: old(name, buckets).unionByName(rows[name])

        # The raw rows of the touched orders; those that were there before may have been placed.
        seen = old("orders", by_order).withColumn("_seen", F.lit(True)).unionByName(rows["orders"].withColumn("_seen", F.lit(False)))
        raw_orders = materialized(among(seen, "id", orders))
        again = raw_orders.filter("_seen").select("id").distinct()
        raw_orders = raw_orders.drop("_seen")
        placed = materialized(self._placed_orders(raw_orders, self._items(both("items", by_order), raw_orders)))
        customers = among(both("customers", by_email), "_email", emails)
        unified = materialized(self._unified(customers.drop("_email"), among(both("recharge", by_email), "_email", emails).drop("_email")))

        touched = store.touched(
            raw_orders.select("customer_id").union(customers.select("id")).union(rows["subscriptions"].select("shopify_customer_id"))
        )
        read = lambda name: store.read(name, self.schemas[name], touched)
        all_unified = replace(
            "unified", self.schemas["unified"], touched, among(read("unified"), "customer_email", emails, "left_anti").unionByName(unified), "shopify_customer_id"
        )
        before = read("fct_orders")
        hot = find_hot_keys(
            _placed(before).select("shopify_customer_id").union(placed.select("shopify_customer_id")), "shopify_customer_id", self.settings.rows_per_task
        )
        all_placed = among(_placed(before), "order_id", again, "left_anti").unionByName(placed)
        after = replace("fct_orders", self.schemas["fct_orders"], touched, self._facts(all_placed, all_unified, hot), "customer_id")
        held = store.read("subscriptions", raw_schemas["subscriptions"], touched)
        new = rows["subscriptions"].filter(store.bucket("shopify_customer_id").isin(touched))
        subscriptions = staging.subscriptions(held.unionByName(new), self.settings)
        replace("dim_customers", self.schemas["dim_customers"], touched, self._dimension(after, all_unified, subscriptions), "customer_id")
        self._recount(before, after, replace)
        store.commit(batch, written)

    def _recount(self, before: DataFrame, after: DataFrame, replace) -> None:
        """Counts of cohorts: less what the touched customers gave, plus what they give now."""
        schema = self.schemas["cohorts"]

        def counts(facts: DataFrame, sign: int) -> DataFrame:
            months = facts.select("customer_id", "acquisition_cohort_month", "order_month").distinct()
            offset = months_between(F.col("acquisition_cohort_month"), F.col("order_month")).cast("bigint")
            return months.filter("acquisition_cohort_month is not null").groupBy(
                F.col("acquisition_cohort_month").alias("cohort_month"), offset.alias("months_since_first_order")
            ).agg((sign * F.count("customer_id")).alias("customers_active"))

        known = self.store.read("cohorts", schema)
        summed = known.unionByName(counts(before, -1)).unionByName(counts(after, 1)).groupBy(*schema.names[:2]).agg(
            F.sum("customers_active").alias("customers_active")
        )
        replace("cohorts", schema, range(self.store.buckets), summed.filter("customers_active > 0"), "cohort_month")

    # Reading

    @property
    def fct_orders(self) -> DataFrame:
        rows = self.store.read("fct_orders", self.schemas["fct_orders"])
        return rows.drop(*_CARRIED)

    @property
    def dim_customers(self) -> DataFrame:
        """Customers; the days since the last order are counted when the table is read."""
        rows = self.store.read("dim_customers", self.schemas["dim_customers"])
        return rows.withColumn("days_since_last_order", days_between(F.col("last_order_at"), core.as_of(self.settings)))

    @property
    def cohort_retention(self) -> DataFrame:
        return reporting.retention_rates(self.store.read("cohorts", self.schemas["cohorts"]))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _keyed(df: DataFrame, key: str) -> DataFrame:
    """``df`` with the cleaned e-mail if that is what its buckets go by."""
    return df.withColumn(key, clean_email(F.col("email"))) if key == "_email" else df


def _placed(facts: DataFrame) -> DataFrame:
    """The placed orders that facts were made of."""
    return facts.filter("_copy = 0").withColumnRenamed("customer_id", "shopify_customer_id").select(*_PLACED)


def _keyed_schema(schema: T.StructType, key: str) -> T.StructType:
    return _nullable(T.StructType([*schema.fields, *([T.StructField(key, T.StringType())] if key == "_email" else [])]))


def _survivors(name: str, df: DataFrame) -> DataFrame:
    """Of copies of a row the one that a full rebuild would keep: copies that lost to it would lose again."""
    if name == "orders":
        return staging.first_deliveries(df)
    if name == "items":
        return staging.first_items(df)
    if name == "customers":
        return staging.newest_customers(df.drop("_email")).withColumnRenamed("customer_email", "_email")
    return df
