"""Data-quality checks as queries: each returns the offending rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.plans.core import as_of
from subledger.settings import Settings


def duplicated(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with how often."""
    known = df.filter(F.col(column).isNotNull())
    return known.groupBy(column).agg(F.count("*").alias("occurrences")).filter(F.col("occurrences") > 1)


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def outside(df: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """Rows with a value not in the list; null is not a value."""
    return df.filter(~F.col(column).isin(accepted))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent; a null key refers to nothing and passes.

    Parent keys are not made distinct first: with a plain shuffle on both sides, adaptive execution can split a key that
    very many children share.
    """
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def failing(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where the condition is false; where it is unknown the row passes."""
    return df.filter(~condition)


def stale(df: DataFrame, column: str, days: int, settings: Settings) -> DataFrame:
    """One row with the newest time when that lies more than ``days`` back."""
    limit = as_of(settings) - F.expr(f"INTERVAL '{int(days)}' DAY")
    newest = F.col("most_recent")
    return df.agg(F.max(column).alias("most_recent")).withColumn("threshold", limit).filter(newest < F.col("threshold"))


def disagreeing_months(report: DataFrame, settings: Settings) -> DataFrame:
    """Months whose shop revenue and settled payments differ by the tolerated share or more."""
    share = F.try_divide(F.abs(F.col("shopify_revenue") - F.col("stripe_net_settled")), F.col("shopify_revenue"))
    return failing(report, share < F.lit(settings.revenue_agreement)).select(
        "order_month", "shopify_revenue", "stripe_net_settled"
    )


# The declared checks.
UNIQUE_AND_NOT_NULL = {
    "raw_shopify__customers": ["id"],
    "raw_recharge__subscriptions": ["id"],
    "raw_recharge__charges": ["id"],
    "raw_recharge__customers": ["id"],
    "raw_stripe__charges": ["id"],
    "raw_stripe__refunds": ["id"],
    "stg_shopify__orders": ["order_id"],
    "stg_shopify__customers": ["shopify_customer_id", "customer_email"],
    "stg_shopify__order_line_items": ["line_item_id"],
    "stg_recharge__subscriptions": ["subscription_id"],
    "stg_recharge__charges": ["charge_id"],
    "stg_recharge__customers": ["recharge_customer_id", "shopify_customer_id"],
    "stg_stripe__charges": ["stripe_charge_id"],
    "stg_stripe__refunds": ["stripe_refund_id"],
    "int_customers__unified": ["shopify_customer_id", "customer_email"],
    "int_orders__enriched": ["order_id"],
    "int_payments__reconciled": ["order_id"],
    "dim_dates": ["date_key"],
    "dim_products": ["sku"],
    "dim_customers": ["customer_id"],
    "fct_orders": ["order_id"],
    "fct_subscriptions": ["subscription_id"],
    "fct_charges": ["charge_id"],
    "rpt_revenue_reconciliation": ["order_month"],
    "rpt_subscription_health": ["report_month"],
}
NOT_NULL_ONLY = {
    "raw_shopify__orders": ["id", "customer_id"],
    "raw_shopify__order_line_items": ["id", "order_id"],
    "raw_recharge__subscriptions": ["customer_id"],
    "raw_recharge__customers": ["shopify_customer_id"],
    "stg_shopify__orders": ["shopify_customer_id", "gross_revenue"],
    "stg_shopify__order_line_items": ["order_id"],
    "stg_recharge__subscriptions": ["recharge_customer_id"],
    "stg_stripe__charges": ["charge_amount"],
    "stg_stripe__refunds": ["refund_amount"],
    "fct_orders": ["customer_id"],
}
_ORDER_STATES = ["paid", "pending", "refunded", "partially_refunded", "voided"]
_CHARGE_STATES = ["SUCCESS", "ERROR", "DECLINED", "QUEUED", "REFUNDED"]
ACCEPTED = {
    ("raw_shopify__orders", "financial_status"): _ORDER_STATES,
    ("raw_recharge__charges", "status"): _CHARGE_STATES,
    ("raw_stripe__charges", "status"): ["succeeded", "failed", "pending"],
    ("stg_shopify__orders", "financial_status"): _ORDER_STATES,
    ("stg_recharge__subscriptions", "subscription_status"): ["active", "cancelled", "expired"],
    ("stg_recharge__charges", "charge_status"): _CHARGE_STATES,
    ("int_payments__reconciled", "reconciliation_status"): [
        "reconciled", "no_stripe_match", "amount_mismatch", "orphaned_refund",
    ],
    ("dim_customers", "customer_type"): ["subscriber", "one_time"],
}
EXPRESSIONS = {
    ("stg_stripe__charges", "charge_amount"): ">= 0",
    ("stg_stripe__refunds", "refund_amount"): "> 0",
    ("fct_subscriptions", "monthly_recurring_revenue"): ">= 0",
    ("rpt_monthly_cohort_retention", "retention_rate"): "<= 1.0",
    ("rpt_subscription_health", "monthly_recurring_revenue"): ">= 0",
}


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str
    violated: Callable[[], Column] | None = None  # None: counted over groups, not row by row


def declared_checks() -> Iterator[Check]:
    for table, columns in UNIQUE_AND_NOT_NULL.items():
        for column in columns:
            yield Check(table, column, "unique")
            yield Check(table, column, "not_null", lambda c=column: F.col(c).isNull())
    for table, columns in NOT_NULL_ONLY.items():
        for column in columns:
            yield Check(table, column, "not_null", lambda c=column: F.col(c).isNull())
    for (table, column), accepted in ACCEPTED.items():
        yield Check(table, column, "accepted_values", lambda c=column, a=accepted: ~F.col(c).isin(a))
    for (table, column), rule in EXPRESSIONS.items():
        yield Check(table, column, "expression", lambda c=column, r=rule: ~F.expr(f"`{c}` {r}"))


def _table_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks of a table. Row-by-row ones are counted per value of the first unique column, so that they take no scan
    and no shuffle of their own; each further unique column takes one.
    """
    by_row, unique = [c for c in checks if c.violated], [c for c in checks if not c.violated]
    counts = [F.count_if(c.violated()).alias(f"n{i}") for i, c in enumerate(by_row)]
    if not unique:
        return _listed(df.agg(*counts), by_row)
    first = unique[0]
    per_value = df.groupBy(F.col(first.column).alias("value")).agg(F.count("*").alias("rows"), *counts)
    repeated = F.count_if(F.col("value").isNotNull() & (F.col("rows") > 1)).alias(f"n{len(by_row)}")
    sums = [F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(by_row))]
    out = _listed(per_value.agg(*sums, repeated), [*by_row, first])
    for check in unique[1:]:
        out = out.unionByName(_listed(duplicated(df, check.column).agg(F.count("*").alias("n0")), [check]))
    return out


def _listed(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """The counts n0, n1, ... of one row as a row per check."""
    results = [
        F.struct(
            F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"), F.lit(c.kind).alias("check_name"),
            F.col(f"n{i}").alias("violations"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*results)))


def report(table: Callable[[str], DataFrame]) -> DataFrame:
    """One row per declared check with its number of violations. ``table`` gives the table of a name: a written one, or a
    planned one, whose inputs Spark then shares where plans agree.
    """
    by_table: dict[str, list[Check]] = {}
    for check in declared_checks():
        by_table.setdefault(check.table, []).append(check)
    return reduce(DataFrame.unionByName, [_table_checks(table(name), checks) for name, checks in by_table.items()])
