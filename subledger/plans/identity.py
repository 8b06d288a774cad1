"""One customer number across the systems, and payments that lost their order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.operators.components import connected_components
from subledger.operators.matching import Side, match_one_to_one
from subledger.plans.intermediate import NO_MATCH
from subledger.settings import Settings

SHOP, SUBSCRIPTION, PAYMENT, EMAIL = "shop", "subscription", "payment", "email"


def node(kind: str, value: Column) -> Column:
    """The name of a record or value in the graph; null without one. Kinds sort in the order of their names."""
    return F.concat(F.lit(f"{kind}:"), value.cast("string"))


def identity_edges(shop: DataFrame, subscription: DataFrame) -> DataFrame:
    """What ties records together: a customer's e-mail, and the shop customer that a subscription customer names."""
    links = [
        (shop, node(SHOP, F.col("id")), node(EMAIL, F.col("email"))),
        (subscription, node(SUBSCRIPTION, F.col("recharge_customer_id")), node(EMAIL, F.col("customer_email"))),
        (subscription, node(SUBSCRIPTION, F.col("recharge_customer_id")), node(SHOP, F.col("shopify_customer_id"))),
    ]
    return reduce(DataFrame.unionByName, [df.select(a.alias("record"), b.alias("tie")) for df, a, b in links])


def customer_identity(shop: DataFrame, subscription: DataFrame, payments: DataFrame) -> DataFrame:
    """Records of all systems with the customer they belong to: the smallest name in their component.

    Payments only hang on e-mails, so they join the customers of theirs afterwards and make the graph no larger. Records that
    nothing ties to another are customers of their own.
    """
    people = identity_edges(shop, subscription)
    found = connected_components(people, "record", "tie")
    names = people.select(F.col("record").alias("node")).union(
        shop.select(node(SHOP, F.col("id")))
    ).union(subscription.select(node(SUBSCRIPTION, F.col("recharge_customer_id")))).dropna().distinct()
    records = names.join(found, "node", "left").select(F.col("node").alias("record"), F.coalesce("component", "node").alias("customer"))
    paid = payments.select(node(PAYMENT, F.col("stripe_charge_id")).alias("record"), node(EMAIL, F.col("customer_email")).alias("node"))
    payers = paid.join(found, "node", "left").select("record", F.coalesce("component", "node", "record").alias("customer"))
    return records.unionByName(payers)


def matched_payments(reconciled: DataFrame, emails: DataFrame, payments: DataFrame, settings: Settings) -> DataFrame:
    """Orders without a payment, paired with payments that name no order: by e-mail, amount and time, each used once."""
    open_orders = reconciled.filter(F.col("reconciliation_status") == NO_MATCH).join(emails, "order_id").select(
        "order_id", "customer_email", "order_created_at_utc", "shopify_gross_revenue"
    )
    loose = payments.filter("shopify_order_id is null").select("stripe_charge_id", "customer_email", "charge_created_at_utc", "charge_amount")
    pairs = match_one_to_one(
        Side(open_orders, "order_id", "customer_email", "order_created_at_utc", "shopify_gross_revenue"),
        Side(loose, "stripe_charge_id", "customer_email", "charge_created_at_utc", "charge_amount"),
        F.lit(settings.match_amount), settings.match_days * 86_400, settings.rows_per_task,
    )
    return pairs.select(F.col("left_id").alias("order_id"), F.col("right_id").alias("stripe_charge_id"), "amount_gap", "seconds_gap")
