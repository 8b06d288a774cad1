"""Dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.functions import days_between, flag, month_of, safe_divide, utc_now
from subledger.operators import HotKeys, left_join_few
from subledger.plans.staging import ACTIVE
from subledger.settings import Settings

# Labels, supply lengths found in variant titles, and how bundles are told from single products.
SUBSCRIBER, ONE_TIME = "subscriber", "one_time"
SUPPLY_TIERS = {"%30-day%": (30, "30-day"), "%90-day%": (90, "90-day")}
OTHER_SUPPLY = "other"
BUNDLE_PATTERN, BUNDLE, SINGLE = "%bundle%", "bundle", "single"


def as_of(settings: Settings) -> Column:
    """A zone-free time in UTC, as all cleaned times are, so that days are counted alike whatever the session's zone."""
    return F.lit(settings.as_of.isoformat(" ")).cast("timestamp_ntz") if settings.as_of else utc_now()


def first_touch(channel: Column, when: Column, order_id: Column) -> Column:
    """The first known channel over all of a customer's orders; orders without one are passed over, undated ones last."""
    return F.min_by(channel, F.when(channel.isNotNull(), history_order(when, order_id)))


def history_order(when: Column, order_id: Column) -> Column:
    """A customer's orders in one order everywhere: by time, then by id, nulls last."""
    return F.struct(when.isNull(), when.alias("when"), order_id.isNull(), order_id.alias("order_id"))


def customer_orders(orders: DataFrame) -> DataFrame:
    """A customer's orders in one aggregate, first touch included: tasks combine before the shuffle."""
    placed = F.col("order_created_at_utc")
    return orders.groupBy("shopify_customer_id").agg(
        F.count("*").alias("lifetime_orders"),
        F.sum("net_revenue").alias("lifetime_revenue"),
        F.min(placed).alias("first_order_at"),
        F.max(placed).alias("last_order_at"),
        month_of(F.min(placed)).alias("acquisition_cohort_month"),
        F.avg("net_revenue").alias("avg_order_value"),
        first_touch(F.col("channel"), placed, F.col("order_id")).alias("acquisition_channel"),
    )


def customer_subscriptions(subscriptions: DataFrame) -> DataFrame:
    active = F.col("subscription_status") == ACTIVE
    return subscriptions.groupBy("shopify_customer_id").agg(
        F.count("*").alias("total_subscriptions"),
        F.count_if(active).alias("active_subscriptions"),
        F.max(F.when(active, F.col("subscription_price"))).alias("current_subscription_price"),
    )


def customers(unified: DataFrame, orders: DataFrame, subscriptions: DataFrame, settings: Settings) -> DataFrame:
    """Customer 360. Both right sides have one row per customer, so customers keep theirs.

    The id is a key that the declared checks watch. Should many records lack one, adaptive execution splits them, as the
    left side of a left join may be.
    """
    return (
        unified.join(customer_orders(orders), "shopify_customer_id", "left")
        .join(customer_subscriptions(subscriptions), "shopify_customer_id", "left")
        .select(
            F.col("shopify_customer_id").alias("customer_id"),
            "customer_email",
            "first_name",
            "last_name",
            "billing_state",
            "customer_created_at_utc",
            "accepts_marketing",
            F.coalesce("lifetime_orders", F.lit(0)).alias("lifetime_orders"),
            F.coalesce("lifetime_revenue", F.lit(0)).alias("lifetime_revenue"),
            "first_order_at",
            "last_order_at",
            "acquisition_cohort_month",
            "avg_order_value",
            "acquisition_channel",
            F.when(F.col("is_subscriber"), SUBSCRIBER).otherwise(ONE_TIME).alias("customer_type"),
            F.coalesce("total_subscriptions", F.lit(0)).alias("total_subscriptions"),
            F.coalesce("active_subscriptions", F.lit(0)).alias("active_subscriptions"),
            "current_subscription_price",
            "is_in_dunning",
            days_between(F.col("last_order_at"), as_of(settings)).alias("days_since_last_order"),
        )
    )


def acquisition(shop_customers: DataFrame, orders: DataFrame) -> DataFrame:
    """The three columns of the customer dimension that order facts need, without building the rest of it.

    ``shop_customers`` has the dimension's rows: its joins neither add nor drop any.
    """
    return shop_customers.select("shopify_customer_id").join(customer_orders(orders), "shopify_customer_id", "left").select(
        F.col("shopify_customer_id").alias("customer_id"), "acquisition_cohort_month", "acquisition_channel"
    )


def dates(days: DataFrame) -> DataFrame:
    """Calendar attributes of a column ``date_day``."""
    day = F.col("date_day")
    year, quarter = F.year(day).cast("string"), F.quarter(day).cast("string")
    return days.select(
        day.alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.month(day).alias("month_number"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayname(day).alias("day_name"),
        F.monthname(day).alias("month_name"),
        month_of(day).alias("month_start"),
        F.last_day(day).alias("month_end"),
        F.quarter(day).alias("quarter_number"),
        F.concat(year, F.lit("-Q"), quarter).alias("year_quarter"),
        F.concat(year, F.lit("-"), F.lpad(F.month(day).cast("string"), 2, "0")).alias("year_month"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def products(line_items: DataFrame) -> DataFrame:
    """Every product, variant and price ever sold: a price change gives a second row."""
    days, tier = F.lit(None).cast("int"), F.lit(OTHER_SUPPLY)
    for pattern, (length, label) in reversed(SUPPLY_TIERS.items()):
        found = F.col("variant_title").ilike(pattern)
        days, tier = F.when(found, length).otherwise(days), F.when(found, label).otherwise(tier)
    sold = line_items.select("product_id", "product_title", "variant_title", "sku", F.col("unit_price").alias("current_price"))
    return sold.distinct().select(
        "*",
        days.alias("supply_duration_days"),
        tier.alias("supply_tier"),
        F.when(F.col("product_title").ilike(BUNDLE_PATTERN), BUNDLE).otherwise(SINGLE).alias("product_type"),
    )


def charge_facts(charges: DataFrame) -> DataFrame:
    created = F.col("charge_created_at_utc")
    return charges.select(
        "charge_id",
        "subscription_id",
        "recharge_customer_id",
        "shopify_order_id",
        "customer_email",
        "charge_created_at_utc",
        F.to_date(created).alias("charge_date"),
        month_of(created).alias("charge_month"),
        "charge_type",
        "charge_status",
        "is_successful_charge",
        "is_failed_charge",
        "charge_total",
        "charge_subtotal",
        "charge_tax",
        "discount_codes",
        "error_message",
        "error_category",
        "payment_processor",
    )


def order_facts(orders: DataFrame, acquired: DataFrame, hot_customers: HotKeys) -> DataFrame:
    """Enriched orders with the customer's cohort and first channel; both null for customers not in the dimension."""
    attributes = acquired.select(
        F.col("customer_id").alias(hot_customers.column), "acquisition_cohort_month", "acquisition_channel"
    )
    return order_fact_columns(left_join_few(orders, attributes, hot_customers, spread=["order_id"]))


def order_facts_from_history(orders: DataFrame, shop_customers: DataFrame) -> DataFrame:
    """The same for orders that carry their customer's attributes already; customers not in the dimension lose them."""
    known = shop_customers.select("shopify_customer_id", F.lit(True).alias("known"))
    joined = orders.join(known, "shopify_customer_id", "left")
    kept = {c: F.when(F.col("known"), F.col(c)) for c in ("acquisition_cohort_month", "acquisition_channel")}
    return order_fact_columns(joined.withColumns(kept))


def order_fact_columns(orders: DataFrame, *extra: str) -> DataFrame:
    return orders.withColumnRenamed("shopify_customer_id", "customer_id").select(
        "order_id",
        "order_number",
        "customer_id",
        F.to_date("order_created_at_utc").alias("order_date"),
        "order_month",
        "acquisition_cohort_month",
        "acquisition_channel",
        "customer_order_sequence",
        flag(F.col("customer_order_sequence") == 1).alias("is_first_order"),
        "gross_revenue",
        "discount_amount",
        "net_revenue",
        "tax_amount",
        "shipping_amount",
        "item_count",
        "total_units",
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


def charge_totals(charges: DataFrame, key: str) -> DataFrame:
    """Attempts, outcomes and revenue of charges per ``key``."""
    paid = F.col("is_successful_charge")
    return charges.groupBy(key).agg(
        F.count("*").alias("total_charge_attempts"),
        F.count_if(paid).alias("successful_charges"),
        F.count_if(F.col("is_failed_charge")).alias("failed_charges"),
        F.sum(F.when(paid, F.col("charge_total")).otherwise(0)).alias("total_charged_revenue"),
    )


def monthly_price(price: Column, interval_days: Column, settings: Settings) -> Column:
    """A price brought to a month of 30 days; quantity and interval unit play no part."""
    days = F.lit(settings.mrr_days)
    months = F.try_divide(days, interval_days) if settings.zero_interval == "null" else days / interval_days
    return F.round(price * months, 2)


def subscription_facts(subscriptions: DataFrame, charges: DataFrame, settings: Settings) -> DataFrame:
    created, ended = F.col("subscription_created_at_utc"), F.col("subscription_cancelled_at_utc")
    recurring = monthly_price(F.col("subscription_price"), F.col("charge_interval_days"), settings)
    totals = charge_totals(charges, "subscription_id")
    return subscriptions.join(totals, "subscription_id", "left").select(
        "subscription_id",
        F.col("shopify_customer_id").alias("customer_id"),
        "customer_email",
        "product_title",
        "variant_title",
        "sku",
        "subscription_price",
        "subscription_frequency_tier",
        "charge_interval_days",
        "subscription_status",
        "subscription_created_at_utc",
        "subscription_cancelled_at_utc",
        "cancellation_reason",
        "had_status_mismatch",
        days_between(created, F.coalesce(ended, as_of(settings))).alias("subscription_duration_days"),
        F.coalesce("total_charge_attempts", F.lit(0)).alias("total_charge_attempts"),
        F.coalesce("successful_charges", F.lit(0)).alias("successful_charges"),
        F.coalesce("failed_charges", F.lit(0)).alias("failed_charges"),
        F.coalesce("total_charged_revenue", F.lit(0)).alias("total_charged_revenue"),
        safe_divide(F.col("failed_charges"), F.col("total_charge_attempts")).alias("failure_rate"),
        F.when(F.col("subscription_status") == ACTIVE, recurring).otherwise(0).alias("monthly_recurring_revenue"),
    )
