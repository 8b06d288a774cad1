"""One cleaned table per raw table: names, types, duplicates, blanks, clocks. No joins.

Ids are typed in the raw schemas, so a blank one is null by the time it gets here and needs no test of its text; a filter
on it then reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.functions import (
    blank_to_null, cents_to_dollars, clean_email, flag, is_blank, money, proper_name, url_parameter, wall_clock,
    zone_to_utc,
)
from subledger.operators import keep_first
from subledger.settings import Settings

# The words of the source systems, the labels given to them, and how messages map to error categories
# (first match wins).
SUBSCRIPTION_SOURCE = "subscription_contract"
ACTIVE, CANCELLED = "active", "cancelled"
CHARGE_SUCCESS = "SUCCESS"
CHARGE_FAILURES = ["ERROR", "DECLINED"]
ERROR_CATEGORIES = {
    "%declined%": "card_declined",
    "%insufficient%": "insufficient_funds",
    "%expired%": "card_expired",
    "%update%": "payment_method_update_needed",
}
OTHER_ERROR = "other_error"
PAYMENT_SUCCESS, PAYMENT_FAILURE = "succeeded", "failed"
SHORT_TIER, LONG_TIER, OTHER_TIER = "30-day", "90-day", "other"
NO_REASON = "not_specified"


def first_deliveries(raw: DataFrame) -> DataFrame:
    """One raw row per order: the earliest delivery, retries dropped. ``created_at`` is fixed-width text in one zone."""
    return keep_first(raw, ["id"], [F.col("created_at").asc_nulls_last()], skip=["id", "created_at"])


def shop_orders(raw: DataFrame, settings: Settings) -> DataFrame:
    return order_columns(first_deliveries(raw), settings)


def order_columns(raw: DataFrame, settings: Settings) -> DataFrame:
    gross, discount = money(F.col("total_price")), money(F.col("total_discounts"))
    return raw.select(
        F.col("id").alias("order_id"),
        "order_number",
        F.col("customer_id").alias("shopify_customer_id"),
        clean_email(F.col("email")).alias("customer_email"),
        zone_to_utc(F.col("created_at"), settings.shop_timezone).alias("order_created_at_utc"),
        money(F.col("subtotal_price")).alias("subtotal_amount"),
        money(F.col("total_tax")).alias("tax_amount"),
        money(F.col("total_shipping")).alias("shipping_amount"),
        gross.alias("gross_revenue"),
        discount.alias("discount_amount"),
        # The total already has the discount taken off; the published definition takes it off again.
        (gross - discount).alias("net_revenue"),
        "financial_status",
        "fulfillment_status",
        "source_name",
        flag(F.col("source_name") == SUBSCRIPTION_SOURCE).alias("is_subscription_order"),
        "discount_codes",
        "tags",
        F.col("billing_address_province").alias("billing_state"),
        url_parameter(F.col("landing_site"), "utm_source").alias("utm_source"),
        url_parameter(F.col("landing_site"), "utm_medium").alias("utm_medium"),
        "cancel_reason",
        "cancelled_at",
    )


def newest_customers(raw: DataFrame) -> DataFrame:
    """One raw row per normalised e-mail, the latest created; customers without an e-mail count as one."""
    keyed = raw.withColumn("customer_email", clean_email(F.col("email")))
    newest = [F.col("created_at").desc_nulls_first()]
    return keep_first(keyed, ["customer_email"], newest, skip=["created_at", "customer_email"])


def shop_customers(raw: DataFrame, settings: Settings) -> DataFrame:
    return newest_customers(raw).select(
        F.col("id").alias("shopify_customer_id"),
        "customer_email",
        proper_name(F.col("first_name")).alias("first_name"),
        proper_name(F.col("last_name")).alias("last_name"),
        F.upper(F.trim("state")).alias("billing_state"),
        zone_to_utc(F.col("created_at"), settings.shop_timezone).alias("customer_created_at_utc"),
        F.col("orders_count").cast("int").alias("shopify_orders_count"),
        money(F.col("total_spent")).alias("shopify_total_spent"),
        flag(F.lower("accepts_marketing") == "true").alias("accepts_marketing"),
        F.col("tags").alias("customer_tags"),
    )


def first_items(raw: DataFrame) -> DataFrame:
    """One raw row per line item. Copies have no order of their own, so the one of smallest digest stays."""
    return keep_first(raw, ["id"], skip=["id"])


def shop_line_items(raw: DataFrame) -> DataFrame:
    return line_item_columns(first_items(raw))


def line_item_columns(raw: DataFrame) -> DataFrame:
    price, quantity = money(F.col("price")), F.col("quantity").cast("int")
    discount = money(F.col("total_discount"))
    return raw.select(
        F.col("id").alias("line_item_id"),
        "order_id",
        "product_id",
        F.col("title").alias("product_title"),
        "variant_title",
        "sku",
        quantity.alias("quantity"),
        price.alias("unit_price"),
        discount.alias("line_discount_amount"),
        (price * quantity).alias("gross_line_amount"),
        (price * quantity - discount).alias("net_line_amount"),
    )


def subscriptions(raw: DataFrame, settings: Settings) -> DataFrame:
    """Subscriptions still called active after their cancellation are cancelled."""
    mismatch = flag((F.col("status") == ACTIVE) & ~is_blank(F.col("cancelled_at")))
    interval = F.col("charge_interval_frequency").cast("int")
    return raw.select(
        F.col("id").alias("subscription_id"),
        F.col("customer_id").alias("recharge_customer_id"),
        "shopify_customer_id",
        clean_email(F.col("email")).alias("customer_email"),
        "product_title",
        "variant_title",
        "sku",
        money(F.col("price")).alias("subscription_price"),
        F.col("quantity").cast("int").alias("quantity"),
        F.when(mismatch, F.lit(CANCELLED)).otherwise(F.lower("status")).alias("subscription_status"),
        mismatch.alias("had_status_mismatch"),
        wall_clock(F.col("created_at")).alias("subscription_created_at_utc"),
        blank_to_null(F.col("cancelled_at"), wall_clock(F.col("cancelled_at"))).alias("subscription_cancelled_at_utc"),
        blank_to_null(F.col("cancellation_reason"), F.lower(F.trim("cancellation_reason"))).alias("cancellation_reason"),
        interval.alias("charge_interval_days"),
        F.lower("order_interval_unit").alias("charge_interval_unit"),
        F.when(interval <= settings.short_interval_days, SHORT_TIER)
        .when(interval <= settings.long_interval_days, LONG_TIER)
        .otherwise(OTHER_TIER)
        .alias("subscription_frequency_tier"),
        blank_to_null(F.col("next_charge_scheduled_at"), wall_clock(F.col("next_charge_scheduled_at"))).alias("next_charge_at_utc"),
    )


def error_category(message: Column) -> Column:
    category = None
    for pattern, label in ERROR_CATEGORIES.items():
        hit = message.ilike(pattern)
        category = F.when(hit, label) if category is None else category.when(hit, label)
    return category.when(~is_blank(message), OTHER_ERROR)


def subscription_charges(raw: DataFrame) -> DataFrame:
    """One row per charge attempt; failed ones may have no order."""
    status = F.upper("status")
    return raw.select(
        F.col("id").alias("charge_id"),
        "subscription_id",
        F.col("customer_id").alias("recharge_customer_id"),
        "shopify_order_id",
        clean_email(F.col("email")).alias("customer_email"),
        wall_clock(F.col("created_at")).alias("charge_created_at_utc"),
        blank_to_null(F.col("processed_at"), wall_clock(F.col("processed_at"))).alias("charge_processed_at_utc"),
        F.upper("type").alias("charge_type"),
        status.alias("charge_status"),
        flag(status == CHARGE_SUCCESS).alias("is_successful_charge"),
        flag(status.isin(CHARGE_FAILURES)).alias("is_failed_charge"),
        money(F.col("total_price")).alias("charge_total"),
        money(F.col("subtotal_price")).alias("charge_subtotal"),
        money(F.col("tax_lines")).alias("charge_tax"),
        "discount_codes",
        blank_to_null(F.col("error_message"), F.trim("error_message")).alias("error_message"),
        error_category(F.col("error_message")).alias("error_category"),
        F.lower("payment_processor").alias("payment_processor"),
    )


def subscription_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("recharge_customer_id"),
        "shopify_customer_id",
        clean_email(F.col("email")).alias("customer_email"),
        proper_name(F.col("first_name")).alias("first_name"),
        proper_name(F.col("last_name")).alias("last_name"),
        wall_clock(F.col("created_at")).alias("recharge_created_at_utc"),
        F.lower("status").alias("recharge_status"),
        flag(F.lower("has_payment_method_in_dunning") == "true").alias("is_in_dunning"),
    )


def payment_charges(raw: DataFrame) -> DataFrame:
    """One row per charge attempt, in dollars. Ghosts are failures no other system knows of."""
    amount, refunded = cents_to_dollars(F.col("amount")), cents_to_dollars(F.col("amount_refunded"))
    order_id, charge_id = F.col("metadata_shopify_order_id"), F.col("metadata_recharge_charge_id")
    return raw.select(
        F.col("id").alias("stripe_charge_id"),
        amount.alias("charge_amount"),
        refunded.alias("refunded_amount"),
        (amount - refunded).alias("net_charge_amount"),
        F.upper("currency").alias("currency"),
        F.col("status").alias("stripe_status"),
        flag(F.col("status") == PAYMENT_SUCCESS).alias("is_successful"),
        wall_clock(F.col("created")).alias("charge_created_at_utc"),
        clean_email(F.col("customer_email")).alias("customer_email"),
        order_id.alias("shopify_order_id"),
        charge_id.alias("recharge_charge_id"),
        F.lower("payment_method_type").alias("payment_method_type"),
        blank_to_null(F.col("failure_code"), F.lower(F.trim("failure_code"))).alias("failure_code"),
        flag((F.col("status") == PAYMENT_FAILURE) & order_id.isNull() & charge_id.isNull()).alias("is_ghost_failure"),
    )


def payment_refunds(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("stripe_refund_id"),
        F.col("charge_id").alias("stripe_charge_id"),
        cents_to_dollars(F.col("amount")).alias("refund_amount"),
        F.upper("currency").alias("currency"),
        F.col("status").alias("refund_status"),
        wall_clock(F.col("created")).alias("refund_created_at_utc"),
        F.coalesce(blank_to_null(F.col("reason"), F.lower(F.trim("reason"))), F.lit(NO_REASON)).alias("refund_reason"),
        F.col("metadata_shopify_order_id").alias("shopify_order_id"),
    )
