"""What was known of customers and subscriptions at a time: versions with validity, and facts joined as of theirs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.operators import as_of_join, versions, with_late_changes
from subledger.settings import Settings

PROFILE = ["channel", "is_subscription_order", "financial_status"]


def profile_changes(orders: DataFrame) -> DataFrame:
    """What each valid order says of its customer from then on."""
    return orders.select("customer_email", F.col("order_created_at_utc").alias("changed_at"), *PROFILE)


def customer_profiles(orders: DataFrame, settings: Settings) -> DataFrame:
    """Type-2 rows of how a customer buys: channel, by subscription or not, state of the order."""
    return versions(profile_changes(orders), "customer_email", "changed_at", PROFILE, settings.rows_per_task)


def customer_profiles_with_late_orders(on_time: DataFrame, late: DataFrame, settings: Settings) -> DataFrame:
    """The same table, made of the orders that came in time, after the others came."""
    observed, more = profile_changes(on_time), profile_changes(late)
    history = customer_profiles(on_time, settings)
    return with_late_changes(history, observed, more, "customer_email", "changed_at", PROFILE, settings.rows_per_task)


def charges_with_profile(charges: DataFrame, profiles: DataFrame, settings: Settings) -> DataFrame:
    """Charge attempts with the customer's profile at the time; null before the first order."""
    attempts = charges.select("charge_id", "customer_email", "charge_created_at_utc", "charge_status", "charge_total")
    return as_of_join(attempts, profiles, "customer_email", "charge_created_at_utc", "valid_from", PROFILE, settings.rows_per_task)


def failed_charges_with_price(charges: DataFrame, settings: Settings) -> DataFrame:
    """Failed attempts with what the subscription was last charged before: the revenue at risk at its price of the time."""
    failed = charges.filter("is_failed_charge").select("charge_id", "subscription_id", "charge_created_at_utc", "charge_total")
    paid = charges.filter("is_successful_charge").select(
        "subscription_id", F.col("charge_created_at_utc").alias("paid_at"), F.col("charge_total").alias("last_price")
    )
    return as_of_join(
        failed, paid, "subscription_id", "charge_created_at_utc", "paid_at", ["paid_at", "last_price"], settings.rows_per_task, strictly_before=True
    )


def monthly_price_at_risk(charges: DataFrame, settings: Settings) -> DataFrame:
    """Per month the failed attempts, and what they would have brought at the price of the time: the published report counts
    past revenue at today's prices."""
    month = F.trunc("charge_created_at_utc", "month").alias("charge_month")
    return failed_charges_with_price(charges, settings).groupBy(month).agg(
        F.count("*").alias("failed_charges"), F.count("last_price").alias("with_earlier_price"), F.sum("last_price").alias("revenue_at_risk")
    )
