"""Named queries over the retail test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.functions import cents_to_dollars, clean_email, days_between, month_of, months_between, safe_divide, zone_to_utc
from subledger.operators.difference import digest_tree, row_changes
from subledger.operators import day_spine, month_spine, number_rows
from subledger.plans import core, dashboards, history, identity, intermediate, lifetimes, quality, reporting, sketches, staging
from subledger.plans.incremental import BucketStore, IncrementalMarts
from subledger.plans.project import Project
from subledger.plans.warehouse import ParquetSink, VersionedSink, build, load_raw, published
from subledger.session import materialized, run_folder
from subledger.settings import Settings
from subledger.sources import RAW_TABLES, CsvSource, ParquetSource, RetailSource

# The window the test tables cover.
RETAIL = Settings(
    as_of=dt.datetime(2001, 12, 31),
    spine_start=dt.date(1995, 1, 1),
    spine_end=dt.date(2002, 1, 1),
    report_start=dt.date(1995, 1, 1),
    report_end=dt.date(2001, 12, 31),
)

REGISTRY: dict[str, Callable[[Project], DataFrame]] = {
    "stg_orders": lambda p: p.stg_shopify__orders,
    "stg_customers": lambda p: p.stg_shopify__customers,
    "stg_line_items": lambda p: p.stg_shopify__order_line_items,
    "stg_subscriptions": lambda p: p.stg_recharge__subscriptions,
    "stg_recharge_charges": lambda p: p.stg_recharge__charges,
    "stg_recharge_customers": lambda p: p.stg_recharge__customers,
    "stg_stripe_charges": lambda p: p.stg_stripe__charges,
    "stg_stripe_refunds": lambda p: p.stg_stripe__refunds,
    "customers_unified": lambda p: p.int_customers__unified,
    "orders_enriched": lambda p: p.int_orders__enriched,
    "payments_reconciled": lambda p: p.int_payments__reconciled,
    "dim_customers": lambda p: p.dim_customers,
    "dim_products": lambda p: p.dim_products,
    "fct_orders": lambda p: p.fct_orders,
    "fct_subscriptions": lambda p: p.fct_subscriptions,
    "fct_charges": lambda p: p.fct_charges,
    "cohort_retention": lambda p: p.rpt_monthly_cohort_retention,
    "revenue_reconciliation": lambda p: p.rpt_revenue_reconciliation,
    "subscription_health": lambda p: p.rpt_subscription_health,
    "dim_dates": lambda p: core.dates(day_spine(order_days(p))),
    # Single operators
    "order_sequence": lambda p: order_sequence(p),
    "first_touch": lambda p: core.customer_orders(p.valid_orders).select("shopify_customer_id", "acquisition_channel"),
    "utm_parse": lambda p: p.stg_shopify__orders.select("order_id", "utm_source", "utm_medium"),
    "listagg_distinct": lambda p: intermediate.order_items(p.stg_shopify__order_line_items),
    "cents_to_dollars": lambda p: p.source.read("stripe", "raw_stripe__charges").select(
        "id", "amount", cents_to_dollars(F.col("amount")).alias("dollars")
    ),
    "safe_divide": lambda p: p.stg_shopify__order_line_items.select(
        "line_item_id", safe_divide(F.col("line_discount_amount"), F.col("quantity") - 1).alias("discount_per_extra_unit")
    ),
    "month_diff": lambda p: core.customer_orders(p.valid_orders).select(
        "shopify_customer_id", months_between(F.col("first_order_at"), F.col("last_order_at")).alias("months_as_customer")
    ),
    "day_diff": lambda p: p.stg_recharge__charges.select(
        "charge_id", days_between(F.col("charge_created_at_utc"), core.as_of(p.settings)).alias("days_ago")
    ),
    "tz_to_utc": lambda p: p.source.read("shopify", "raw_shopify__orders").select(
        "id", "created_at", zone_to_utc(F.col("created_at"), p.settings.shop_timezone).alias("created_at_utc")
    ),
    "error_category": lambda p: p.stg_recharge__charges.groupBy("error_category").agg(
        F.count("*").alias("charges"), F.sum("charge_total").alias("charge_total")
    ),
    "conditional_distinct": lambda p: charged_subscriptions(p.fct_charges),
    "distinct_products": lambda p: p.stg_shopify__order_line_items.select("product_id", "product_title", "sku").distinct(),
    "month_spine": lambda p: dense_order_months(p),
    # Checks
    "dq_unique": lambda p: quality.duplicated(p.source.read("shopify", "raw_shopify__order_line_items"), "id").unionByName(
        quality.duplicated(p.source.read("shopify", "raw_shopify__orders"), "id")
    ),
    "dq_not_null": lambda p: quality.missing(p.stg_stripe__charges, "shopify_order_id").select("stripe_charge_id", "stripe_status"),
    "dq_accepted_values": lambda p: quality.outside(
        p.source.read("recharge", "raw_recharge__charges"), "status", quality.ACCEPTED["raw_recharge__charges", "status"]
    ).select("id", "status"),
    "dq_relationships": lambda p: quality.orphans(
        p.valid_orders, "shopify_customer_id", p.stg_shopify__customers, "shopify_customer_id"
    ).select("order_id", "shopify_customer_id"),
    "dq_expression": lambda p: quality.failing(p.int_payments__reconciled, F.col("stripe_net_settled") >= 0).select(
        "order_id", "stripe_net_settled"
    ),
    "dq_recency": lambda p: quality.stale(p.stg_shopify__orders, "order_created_at_utc", p.settings.recency_days, p.settings),
    "dq_tolerance": lambda p: quality.disagreeing_months(p.rpt_revenue_reconciliation, p.settings),
    "dq_report": lambda p: quality.report(copies_dropped_once(p).table),
    "dq_fact_relationships": lambda p: quality.orphans(p.fct_orders, "customer_id", p.dim_customers, "customer_id").select(
        "order_id", "customer_id"
    ),
    # Readers
    "csv_to_view": lambda p: csv_to_view(p),
    "rebuilt_fct_orders": lambda p: rebuilt(p, "fct_orders"),
    # Tables kept up to date from batches
    "incremental_fct_orders": lambda p: in_batches(p).fct_orders,
    "incremental_dim_customers": lambda p: in_batches(p).dim_customers,
    "incremental_cohort_retention": lambda p: in_batches(p).cohort_retention,
    # Versions and joins as of a time
    "customer_history": lambda p: history.customer_profiles(p.valid_orders, p.settings),
    "customer_history_late": lambda p: history.customer_profiles_with_late_orders(
        p.valid_orders.filter("order_id % 5 <> 0"), p.valid_orders.filter("order_id % 5 = 0"), p.settings
    ),
    "charges_as_of": lambda p: history.charges_with_profile(
        p.fct_charges, history.customer_profiles(p.valid_orders, p.settings), p.settings
    ),
    "failed_charge_price": lambda p: history.failed_charges_with_price(p.fct_charges, p.settings),
    "revenue_at_risk": lambda p: history.monthly_price_at_risk(p.fct_charges, p.settings),
    # Across the systems
    "matched_payments": lambda p: identity.matched_payments(
        p.int_payments__reconciled, p.stg_shopify__orders.select("order_id", "customer_email"), p.stg_stripe__charges, p.settings
    ),
    "customer_identity": lambda p: identity.customer_identity(
        p.source.read("shopify", "raw_shopify__customers").select("id", clean_email(F.col("email")).alias("email")),
        p.stg_recharge__customers, p.stg_stripe__charges,
    ),
    # Lifetimes
    "customer_streaks": lambda p: lifetimes.streaks(reporting.customer_months(p.valid_orders, p.stg_shopify__customers)),
    "channel_credit": lambda p: lifetimes.channel_credit(p.valid_orders),
    "subscription_survival": lambda p: lifetimes.survival(p.stg_recharge__subscriptions, p.settings),
    # Sketches and differences
    "sketch_rollup": lambda p: sketches.checked_rollup(sketches.order_lines(p.valid_orders, p.stg_shopify__order_line_items), ["channel"]),
    "sketch_rollup_by_month": lambda p: sketches.checked_rollup(
        sketches.order_lines(p.valid_orders, p.stg_shopify__order_line_items), ["channel", "order_month"]
    ),
    "sketch_retention": lambda p: sketches.checked_retention(reporting.customer_months(p.valid_orders, p.stg_shopify__customers)),
    "order_differences": lambda p: order_differences(p),
    # Dashboard tables
    "churn_mrr_bridge": lambda p: dashboards.mrr_bridge(p.stg_recharge__subscriptions, p.settings),
    "active_mom_change": lambda p: dashboards.active_change(p.rpt_subscription_health),
    "ltv_curve": lambda p: dashboards.cohort_value(p.valid_orders, p.stg_shopify__customers),
    "ltv_by_channel": lambda p: dashboards.channel_value(p.dim_customers),
    "channel_conversion": lambda p: dashboards.channel_conversion(p.dim_customers),
    "refund_rate": lambda p: dashboards.refund_rate(p.rpt_revenue_reconciliation),
    "dunning_recovery": lambda p: dashboards.dunning_recovery(p.fct_charges, p.settings),
    "subscription_health_recovery": lambda p: health_with_recovery(p),
    "retention_by_segment": lambda p: reporting.cohort_retention(
        reporting.customer_months(p.valid_orders, p.stg_shopify__customers), within=["acquisition_channel"]
    ),
    "retention_by_product": lambda p: retention_within(p, first_products(p), "first_products"),
    "retention_by_interval": lambda p: retention_within(p, subscription_tiers(p), "subscription_tier"),
    "channel_first_vs_repeat": lambda p: dashboards.channel_orders(p.fct_orders),
}


def retention_within(p: Project, attributes: DataFrame, column: str) -> DataFrame:
    """Cohort retention within an attribute of the customer; null for customers without it."""
    months = reporting.customer_months(p.valid_orders, p.stg_shopify__customers)
    return reporting.cohort_retention(months.join(attributes, "customer_id", "left"), within=[column])


def first_products(p: Project) -> DataFrame:
    """What was in each customer's first order. Orders are reduced to the first per customer before they meet any items."""
    first = F.min(core.history_order(F.col("order_created_at_utc"), F.col("order_id"))).alias("first")
    orders = p.valid_orders.groupBy(F.col("shopify_customer_id").alias("customer_id")).agg(first).select(
        "customer_id", F.col("first.order_id").alias("order_id")
    )
    items = intermediate.order_items(p.stg_shopify__order_line_items).select("order_id", F.col("product_names").alias("first_products"))
    return orders.join(items, "order_id").select("customer_id", "first_products")


def subscription_tiers(p: Project) -> DataFrame:
    """The tier of each customer's first subscription."""
    placed = core.history_order(F.col("subscription_created_at_utc"), F.col("subscription_id"))
    return p.stg_recharge__subscriptions.groupBy(F.col("shopify_customer_id").alias("customer_id")).agg(
        F.min_by("subscription_frequency_tier", placed).alias("subscription_tier")
    )


def health_with_recovery(p: Project) -> DataFrame:
    """The monthly subscription report with the share of failed charges recovered later. Both have one row per month."""
    recovery = dashboards.dunning_recovery(p.fct_charges, p.settings).select(
        F.col("charge_month").alias("report_month"), "recovered_charges", "recovery_rate"
    )
    return p.rpt_subscription_health.join(recovery, "report_month", "left").orderBy("report_month")


def csv_to_view(p: Project) -> DataFrame:
    """Customers per state from a view over raw tables that were headed CSV files: written, loaded with ``load_raw``, read
    through the view that ``build`` would make of them.
    """
    files, loaded = run_folder(p.spark), run_folder(p.spark)
    for system, tables in RAW_TABLES.items():
        for table in tables:
            p.source.read(system, table).write.csv(f"{files}/{table}.csv", header=True)
    load_raw(CsvSource(p.spark, files), ParquetSink(p.spark, loaded))
    customers = Project(ParquetSource(p.spark, f"{loaded}/raw"), p.settings).stg_shopify__customers
    customers.createOrReplaceTempView("stg_shopify__customers")
    return p.spark.sql("select billing_state, count(*) as customers from stg_shopify__customers group by billing_state")


def in_batches(p: Project) -> IncrementalMarts:
    """The marts after a first load and three batches of rows by when they arrived: orders by year, an order's retry and
    a fifth of all items a batch after it, undated orders last.
    """
    marts = IncrementalMarts(BucketStore(p.spark, run_folder(p.spark), 16), p.settings)
    read = lambda name: p.source.read(*marts.RAW[name][:2])
    year = F.substring("created_at", 1, 4).try_cast("int")
    retry = F.substring("created_at", 18, 2) != "00"
    by_year = lambda first: F.least(F.lit(3), F.greatest(F.lit(0), year - first))
    arrival = {
        "orders": F.least(F.lit(3), F.coalesce(by_year(1996) + retry.cast("int"), F.lit(3))),
        "items": F.when(F.col("order_id") % 5 == 0, 1 + F.pmod("order_id", F.lit(3))).otherwise(0),
        "customers": F.pmod(F.col("id"), F.lit(4)),
        "recharge": F.pmod(F.floor(F.col("shopify_customer_id") / 3), F.lit(4)),
        "subscriptions": F.coalesce(by_year(1996), F.lit(3)),
    }
    for batch in range(4):
        marts.apply(f"batch {batch}", **{name: read(name).filter(when == batch) for name, when in arrival.items()})
    return marts


def copies_dropped_once(p: Project) -> Project:
    """The project for a report on all of its tables, in which these drop the copies of orders and items in one pass each.

    Spark shares a shuffle between plans that agree to the column, but leaves each plan only the columns it uses. The
    condition, which every row meets, names what any of the tables uses; below it their plans are the same.
    """
    def together(df: DataFrame, *columns: str) -> DataFrame:
        return df.filter(F.xxhash64(*columns) >= F.lit(-(2**63)))

    orders = staging.first_deliveries(p.source.read("shopify", "raw_shopify__orders"))
    items = staging.first_items(p.source.read("shopify", "raw_shopify__order_line_items"))
    orders = together(orders, "id", "customer_id", "created_at", "financial_status", "total_price", "total_discounts", "landing_site")
    items = together(items, "id", "order_id", "product_id", "title", "variant_title", "sku", "price")
    p.stg_shopify__orders = staging.order_columns(orders, p.settings)
    p.stg_shopify__order_line_items = staging.line_item_columns(items)
    return p


def order_differences(p: Project) -> DataFrame:
    """Two builds of the orders, written by month with their digest trees: the later one lacks some orders of a year, has one
    twice, and another state for others. Only months that differ are read again.
    """
    orders = p.valid_orders.select(
        "order_id", "shopify_customer_id", month_of(F.col("order_created_at_utc")).alias("order_month"), "gross_revenue", "financial_status", "channel"
    )
    year = F.year("order_month") == 1997
    state = F.when(year & (F.col("order_id") % 50 == 4), "refunded").otherwise(F.col("financial_status"))
    later = orders.filter(F.coalesce(~(year & (F.col("order_id") % 40 == 9)), F.lit(True))).withColumn("financial_status", state)
    later = later.unionByName(later.filter(year & (F.col("order_id") % 60 == 2)))
    builds, trees, root = [], [], run_folder(p.spark)
    for name, df in (("before", orders), ("after", later)):
        df.hint("rebalance", "order_month").write.partitionBy("order_month").parquet(f"{root}/{name}")
        builds.append(p.spark.read.schema(df.schema).parquet(f"{root}/{name}").select(*df.columns))
        trees.append(materialized(digest_tree(builds[-1], ["order_id"], "order_month")))
    return row_changes(*builds, tuple(trees), ["order_id"], "order_month")


def rebuilt(p: Project, table: str) -> DataFrame:
    """A core table of the version that readers find after a full rebuild of all tables."""
    root = run_folder(p.spark)
    sink = VersionedSink(p.spark, root)
    schema = build(Project(p.source, p.settings), sink).table(table).schema
    sink.publish(1)
    return p.spark.read.schema(schema).parquet(f"{published(p.spark, root)}/marts/{table}").select(*schema.names)


def order_days(p: Project) -> DataFrame:
    """First day of the order history and the day after its last: the bounds of a calendar over it."""
    day = F.to_date("order_created_at_utc")
    return p.stg_shopify__orders.agg(F.min(day).alias("start"), F.date_add(F.max(day), 1).alias("end"))


def order_sequence(p: Project) -> DataFrame:
    orders = p.valid_orders.select("order_id", "shopify_customer_id", "order_created_at_utc")
    return number_rows(orders, ["order_created_at_utc", "order_id"], "customer_order_sequence", p.hot_customers)


def charged_subscriptions(charges: DataFrame) -> DataFrame:
    """Distinct subscriptions charged and failed per month: one row per subscription and month first, then plain counts."""
    per_subscription = charges.groupBy("charge_month", "subscription_id").agg(
        F.max("is_successful_charge").alias("paid"), F.max("is_failed_charge").alias("failed")
    )
    known = F.col("subscription_id").isNotNull()
    return per_subscription.groupBy("charge_month").agg(
        F.count_if(known).alias("subscriptions"),
        F.count_if(known & F.col("paid")).alias("paid_subscriptions"),
        F.count_if(known & F.col("failed")).alias("failed_subscriptions"),
    )


def dense_order_months(p: Project) -> DataFrame:
    """Orders per month over the report's month spine, 0 where there were none."""
    first, last = reporting.report_months(p.settings)
    monthly = p.stg_shopify__orders.groupBy(month_of(F.col("order_created_at_utc")).alias("report_month")).agg(
        F.count("*").alias("orders")
    )
    months = month_spine(p.spark, first, last).join(monthly, "report_month", "left")
    return months.select("report_month", F.coalesce("orders", F.lit(0)).alias("orders"))


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as double and whole numbers as bigint, the types both engines hash alike."""
    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema])


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return plain_types(REGISTRY[name](Project(RetailSource(spark, folder), RETAIL)))
