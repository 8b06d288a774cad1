"""The raw tables, derived from star-schema retail tables (customer, nation, orders, lineitem, events).

The column expressions mean the same in Spark and in DuckDB, so the checks build their inputs from this text too.
They plant the defects the models exist for: webhook retries, orders without a time, e-mail spellings, blank fields, lost attribution, status
mismatches, wrong amounts, orphaned refunds and failed charges nobody asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.sources.schemas import raw_schema

_NONE = "cast(null as string)"


def _email(key: str) -> str:
    return f"'cust' || cast({key} as string) || '@example.com'"


def _day(base: str, days: str) -> str:
    return f"cast(date '{base}' + cast({days} as int) as string)"


def _order_day(extra: str = "") -> str:
    return f"cast(cast(o_orderdate as date){extra} as string)"


def _two(number: str) -> str:
    return f"lpad(cast({number} as string), 2, '0')"


_SUBSCRIBED = "c_custkey % 10 < 6"
_CANCELLED = "c_custkey % 10 < 2 or c_custkey % 30 = 2"

# table -> parts to put under one another, each an input, a condition and {column: expression}. Inputs are the retail
# tables, "residents" (customers with their nation) and "deliveries" (orders with a column "delivery": 0 for the first
# arrival, 1 for the retry some orders get). The conditions are part of the data: not every customer subscribes, not
# every order was paid or refunded.
COLUMNS: dict[str, list[tuple[str, str, dict[str, str]]]] = {
    "raw_shopify__customers": [("residents", "", {
        "id": "c_custkey",
        "email": "case when c_custkey % 50 = 49 then ' CUST' || cast(c_custkey - 1 as string) || '@Example.com ' "
                 f"else {_email('c_custkey')} end",
        "first_name": "lower(c_mktsegment)",
        "last_name": "c_name",
        "state": "lower(n_name)",
        "created_at": _day("1994-01-01", "c_custkey % 365") + " || 'T12:00:00-05:00'",
        "orders_count": "cast(c_custkey % 20 as int)",
        "total_spent": "c_acctbal",
        "tags": "''",
        "accepts_marketing": "case when c_custkey % 4 = 3 then 'false' else 'True' end",
    })],
    "raw_shopify__orders": [("deliveries", "", {
        "id": "o_orderkey",
        "order_number": "10000 + o_orderkey",
        "customer_id": "o_custkey",
        "email": _email("o_custkey"),
        "created_at": "case when o_orderkey % 37 <> 5 then " + _order_day() + " || 'T' || " + _two("8 + o_orderkey % 12")
                      + " || ':00:' || case when delivery = 0 then '00' else " + _two("1 + o_orderkey % 30")
                      + " end || '-05:00' end",
        "financial_status": "case o_orderkey % 25 when 0 then 'voided' when 1 then 'refunded' "
                            "when 2 then 'partially_refunded' when 3 then 'pending' else 'paid' end",
        "fulfillment_status": "case o_orderstatus when 'F' then 'fulfilled' when 'O' then 'unfulfilled' "
                              "else 'partial' end",
        "subtotal_price": "o_totalprice",
        "total_tax": "cast(0 as double)",
        "total_shipping": "cast(0 as double)",
        "total_price": "o_totalprice",
        "total_discounts": "case when o_orderkey % 10 = 0 then cast(100.25 as double) else cast(0 as double) end",
        "discount_codes": _NONE,
        "source_name": "case when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 'subscription_contract' "
                       "else 'web' end",
        "landing_site": "case when o_orderkey % 10 < 4 then '/' when o_orderkey % 10 = 4 then '/?utm_source=email' "
                        "when o_orderkey % 10 = 5 then '/?utm_source=&utm_medium=cpc' "
                        "else '/?utm_source=' || lower(substr(o_orderpriority, 3, 4)) || '&utm_medium=paid' end",
        "referring_site": _NONE,
        "cancel_reason": _NONE,
        "cancelled_at": _NONE,
        "tags": "''",
        "billing_address_province": _NONE,
    })],
    "raw_shopify__order_line_items": [("lineitem", "", {
        "id": "l_orderkey * 10 + l_linenumber",
        "order_id": "l_orderkey",
        "product_id": "'PROD_' || cast(l_partkey % 7 as string)",
        "title": "case l_partkey % 7 when 6 then 'Complete Bundle' else 'Item ' || cast(l_partkey % 7 as string) end",
        "variant_title": "case l_partkey % 3 when 0 then '30-day supply' when 1 then '90-DAY supply' else 'sample' end",
        "sku": "'SKU-' || cast(l_partkey % 7 as string) || '-' || cast(l_partkey % 3 as string)",
        "quantity": "cast(l_quantity as int)",
        "price": "cast(29.99 as double) + l_partkey % 7 * 10",
        "total_discount": "l_discount * 100",
    })],
    "raw_recharge__customers": [("customer", _SUBSCRIBED, {
        "id": "9000000000 + c_custkey",
        "shopify_customer_id": "c_custkey",
        "email": _email("c_custkey"),
        "first_name": "lower(c_mktsegment)",
        "last_name": "c_name",
        "created_at": _day("1994-01-01", "c_custkey % 365") + " || 'T17:00:00Z'",
        "status": "'ACTIVE'",
        "has_payment_method_in_dunning": "case when c_custkey % 30 = 0 then 'true' else 'false' end",
    })],
    "raw_recharge__subscriptions": [("customer", _SUBSCRIBED, {
        "id": "3000000000 + c_custkey",
        "customer_id": "9000000000 + c_custkey",
        "shopify_customer_id": "c_custkey",
        "email": _email("c_custkey"),
        "product_title": "case c_custkey % 7 when 6 then 'Complete Bundle' else 'Item ' || cast(c_custkey % 7 as string) end",
        "variant_title": "case c_custkey % 3 when 0 then '30-day supply' when 1 then '90-DAY supply' else 'sample' end",
        "sku": "'SKU-' || cast(c_custkey % 7 as string) || '-' || cast(c_custkey % 3 as string)",
        "price": "cast(29.99 as double) + c_custkey % 5 * 10",
        "quantity": "1",
        "status": "case c_custkey % 10 when 0 then 'cancelled' when 1 then 'expired' else 'active' end",
        "created_at": _day("1995-01-01", "c_custkey * 37 % 2000") + " || 'T00:00:00Z'",
        "cancelled_at": f"case when {_CANCELLED} then "
                        + _day("1995-01-01", "c_custkey * 37 % 2000 + c_custkey % 400") + " || 'T00:00:00Z' else '' end",
        "cancellation_reason": "case when c_custkey % 10 = 0 then ' Too_Expensive ' else '' end",
        "charge_interval_frequency": "case c_custkey % 4 when 0 then 30 when 1 then 60 when 2 then 90 else 120 end",
        "order_interval_unit": "'DAY'",
        "next_charge_scheduled_at": _NONE,
    })],
    "raw_recharge__charges": [("orders", "o_custkey % 10 < 6", {
        "id": "1000000000 + o_orderkey",
        "subscription_id": "3000000000 + o_custkey",
        "customer_id": "9000000000 + o_custkey",
        "shopify_order_id": "case when o_orderkey % 25 = 3 then null else o_orderkey end",
        "email": _email("o_custkey"),
        "created_at": _order_day() + " || 'T' || " + _two("13 + o_orderkey % 11") + " || ':00:00Z'",
        "processed_at": "case when o_orderkey % 25 = 3 then '' else "
                        + _order_day() + " || 'T' || " + _two("13 + o_orderkey % 11") + " || ':00:00Z' end",
        "type": "'recurring'",
        "status": "case when o_orderkey % 25 <> 3 then 'success' when o_orderkey % 2 = 0 then 'ERROR' else 'Declined' end",
        "total_price": "o_totalprice",
        "subtotal_price": "o_totalprice",
        "tax_lines": "cast(0 as double)",
        "discount_codes": _NONE,
        "error_message": "case when o_orderkey % 25 <> 3 then '' else case o_custkey % 5 when 0 then 'Card declined' "
                         "when 1 then 'Insufficient funds' when 2 then 'Card expired' "
                         "when 3 then 'Payment method requires update' else 'Gateway timeout' end end",
        "payment_processor": "'Stripe'",
    })],
    "raw_stripe__charges": [
        ("orders", "o_orderkey % 33 <> 5", {
            "id": "'ch_' || cast(o_orderkey as string)",
            "amount": "cast(round(o_totalprice * 100) as bigint) + case when o_orderkey % 40 = 11 then 500 else 0 end",
            "amount_refunded": "cast(0 as bigint)",
            "currency": "'usd'",
            "status": "case when o_orderkey % 25 = 3 then 'failed' else 'succeeded' end",
            "created": _order_day() + " || 'T13:00:00Z'",
            "customer_email": _email("o_custkey"),
            "metadata_shopify_order_id": "case when o_orderkey % 25 = 3 then null else o_orderkey end",
            "metadata_recharge_charge_id": "1000000000 + o_orderkey",
            "payment_method_type": "'Card'",
            "failure_code": "case when o_orderkey % 25 = 3 then ' Card_Declined ' else '' end",
            "failure_message": _NONE,
        }),
        ("events", "event_type = 'error'", {
            "id": "'ch_ghost_' || cast(event_id as string)",
            "amount": "cast(round(value * 100) as bigint)",
            "amount_refunded": "cast(0 as bigint)",
            "currency": "'usd'",
            "status": "'failed'",
            "created": "cast(cast(ts as date) as string) || 'T00:00:00Z'",
            "customer_email": _NONE,
            "metadata_shopify_order_id": "cast(null as bigint)",
            "metadata_recharge_charge_id": "cast(null as bigint)",
            "payment_method_type": "'Card'",
            "failure_code": "''",
            "failure_message": _NONE,
        }),
    ],
    "raw_stripe__refunds": [("orders", "o_orderkey % 25 in (1, 2) or o_orderkey % 100 = 8", {
        "id": "'re_' || cast(o_orderkey as string)",
        "charge_id": "'ch_' || cast(o_orderkey as string)",
        "amount": "cast(round(o_totalprice * case when o_orderkey % 25 = 1 then 100 else 40 end) as bigint)",
        "currency": "'usd'",
        "status": "'succeeded'",
        "created": _order_day(" + cast(1 + o_orderkey % 30 as int)") + " || 'T09:00:00Z'",
        "reason": "case o_orderkey % 3 when 0 then '' when 1 then ' Duplicate ' else 'requested_by_customer' end",
        "metadata_shopify_order_id": "o_orderkey",
    })],
}

# Every fiftieth order is delivered a second time, some seconds later.
RETRIED = "o_orderkey % 50 = 7"


# The inputs that are not tables, as a query each.
INPUTS = {
    "residents": "select * from customer join nation on c_nationkey = n_nationkey",
    "deliveries": f"select *, unnest(case when {RETRIED} then [0, 1] else [0] end) as delivery from orders",
}


def raw_select(table: str) -> str:
    """The SELECT that derives a raw table."""
    return " union all ".join(
        "select " + ", ".join(f"{expression} as {column}" for column, expression in columns.items())
        + f" from {source}" + (f" where {condition}" if condition else "")
        for source, condition, columns in COLUMNS[table]
    )


class RetailSource:
    """Raw tables over Parquet files ``<folder>/{customer,nation,orders,lineitem,events}.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._frames: dict[str, DataFrame] = {}

    def frame(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._read(name)
        return self._frames[name]

    def _read(self, name: str) -> DataFrame:
        if name == "residents":
            return self.frame("customer").join(self.frame("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        if name == "deliveries":
            times = F.expr(f"explode(case when {RETRIED} then array(0, 1) else array(0) end) as delivery")
            return self.frame("orders").select("*", times)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def read(self, system: str, table: str) -> DataFrame:
        types = {f.name: f.dataType.simpleString() for f in raw_schema(system, table)}
        parts = []
        for source, condition, columns in COLUMNS[table]:
            df = self.frame(source)
            rows = df.filter(condition) if condition else df
            parts.append(rows.selectExpr(*[f"cast({e} as {types[c]}) as {c}" for c, e in columns.items()]))
        return reduce(DataFrame.unionAll, parts)
