"""Joins across the source systems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.functions import month_of
from subledger.operators import HotKeys, keep_first, left_join_many, number_rows
from subledger.plans.staging import PAYMENT_SUCCESS
from subledger.settings import Settings

# Order states that count as refunded, the state that removes an order, and the four outcomes.
VOIDED = "voided"
REFUNDED = ["refunded", "partially_refunded"]
RECONCILED, NO_MATCH, MISMATCH, ORPHANED = "reconciled", "no_stripe_match", "amount_mismatch", "orphaned_refund"


def unified_customers(shop: DataFrame, subscription: DataFrame) -> DataFrame:
    """Shop customers with the latest subscription-side record of the same e-mail."""
    newest = [F.col("recharge_created_at_utc").desc_nulls_first()]
    match = keep_first(subscription, ["customer_email"], newest, skip=["customer_email", "recharge_created_at_utc"]).select(
        "customer_email", "recharge_customer_id", "recharge_status", "is_in_dunning"
    )
    return shop.join(match, "customer_email", "left").select(
        "shopify_customer_id",
        "recharge_customer_id",
        "customer_email",
        "first_name",
        "last_name",
        "billing_state",
        "customer_created_at_utc",
        "shopify_orders_count",
        "shopify_total_spent",
        "accepts_marketing",
        F.col("recharge_customer_id").isNotNull().alias("is_subscriber"),
        "recharge_status",
        "is_in_dunning",
    )


def distinct_list(column: str) -> Column:
    """The distinct values in order, joined by commas; '' when all are null. Tasks merge sets, not rows."""
    return F.array_join(F.sort_array(F.collect_set(column)), ", ")


def order_items(line_items: DataFrame) -> DataFrame:
    return line_items.groupBy("order_id").agg(
        F.count("*").alias("item_count"),
        F.sum("quantity").alias("total_units"),
        F.sum("net_line_amount").alias("line_item_revenue"),
        distinct_list("product_title").alias("product_names"),
        distinct_list("sku").alias("skus"),
    )


def channel(source: Column, medium: Column) -> Column:
    """``source / medium``; null without a source, but an empty source is one."""
    return F.when(source.isNotNull(), F.concat(source, F.lit(" / "), F.coalesce(medium, F.lit("(none)"))))


def valid_orders(orders: DataFrame) -> DataFrame:
    """Orders that count: a voided one does not, nor does one without a state."""
    return orders.filter(F.col("financial_status") != VOIDED).withColumn(
        "channel", channel(F.col("utm_source"), F.col("utm_medium"))
    )


HISTORY = ["order_created_at_utc", "order_id"]


def order_history(orders: DataFrame, line_items: DataFrame, hot_customers: HotKeys) -> DataFrame:
    """Valid orders with what was in them and their place in the customer's history."""
    joined = valid_orders(orders).join(order_items(line_items), "order_id", "left")
    return number_rows(joined, HISTORY, "customer_order_sequence", hot_customers)


def with_acquisition(history: DataFrame) -> DataFrame:
    """Cohort and first channel beside every order, over the partitions and the order the sequence was numbered in.

    For customers whose orders fit one task. The first row has the earliest time, or none if all are undated.
    """
    so_far = Window.partitionBy("shopify_customer_id").orderBy(*[F.col(c).asc_nulls_last() for c in HISTORY])
    all_orders = so_far.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return history.withColumns({
        "acquisition_cohort_month": month_of(F.first("order_created_at_utc").over(so_far)),
        "acquisition_channel": F.first("channel", ignorenulls=True).over(all_orders),
    })


def enriched_orders(history: DataFrame, *extra: str) -> DataFrame:
    return history.select(
        "order_id",
        "order_number",
        "shopify_customer_id",
        "customer_email",
        "order_created_at_utc",
        month_of(F.col("order_created_at_utc")).alias("order_month"),
        "customer_order_sequence",
        "gross_revenue",
        "discount_amount",
        "net_revenue",
        "tax_amount",
        "shipping_amount",
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        F.coalesce("total_units", F.lit(0)).alias("total_units"),
        "product_names",
        "skus",
        "is_subscription_order",
        "financial_status",
        "fulfillment_status",
        "discount_codes",
        "billing_state",
        "utm_source",
        "utm_medium",
        "channel",
        *extra,
    )


def refunds_per_order(refunds: DataFrame) -> DataFrame:
    return refunds.filter(F.col("shopify_order_id").isNotNull()).groupBy(F.col("shopify_order_id").alias("order_id")).agg(
        F.sum("refund_amount").alias("total_refund_amount"), F.count("*").alias("refund_count")
    )


def successful_payments(charges: DataFrame) -> DataFrame:
    """Charges an order can be matched to, keyed by the order. Tested on the status itself, which a scan can filter on."""
    successful = F.col("stripe_status") == PAYMENT_SUCCESS
    return charges.filter(successful & F.col("shopify_order_id").isNotNull()).select(
        F.col("shopify_order_id").alias("order_id"), "stripe_charge_id", "charge_amount", "stripe_status", "is_successful"
    )


def reconciled_payments(
    orders: DataFrame, payments: DataFrame, refunds: DataFrame, hot_orders: HotKeys, settings: Settings
) -> DataFrame:
    """Orders beside their successful charges and the sum of their refunds. Two charges give the order two rows."""
    facts = orders.join(refunds_per_order(refunds), "order_id", "left")
    joined = left_join_many(facts, payments, hot_orders, spread=["stripe_charge_id"])

    charge, refunded = F.col("charge_amount"), F.col("total_refund_amount")
    gap = F.col("gross_revenue") - charge
    # A missing order state decides neither way and so ends up reconciled.
    unnoticed_refund = (refunded > 0) & ~F.col("financial_status").isin(REFUNDED)
    return joined.select(
        "order_id",
        "order_created_at_utc",
        month_of(F.col("order_created_at_utc")).alias("order_month"),
        "shopify_customer_id",
        F.col("gross_revenue").alias("shopify_gross_revenue"),
        F.col("financial_status").alias("shopify_financial_status"),
        "stripe_charge_id",
        charge.alias("stripe_charge_amount"),
        "stripe_status",
        F.col("is_successful").alias("stripe_is_successful"),
        F.coalesce(refunded, F.lit(0)).alias("stripe_refund_amount"),
        F.coalesce("refund_count", F.lit(0)).alias("stripe_refund_count"),
        (F.coalesce(charge, F.lit(0)) - F.coalesce(refunded, F.lit(0))).alias("stripe_net_settled"),
        F.when(F.col("stripe_charge_id").isNull(), NO_MATCH)
        .when(F.abs(gap) > F.lit(settings.amount_tolerance), MISMATCH)
        .when(unnoticed_refund, ORPHANED)
        .otherwise(RECONCILED)
        .alias("reconciliation_status"),
        gap.alias("revenue_variance"),
    )
