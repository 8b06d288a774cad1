"""Tables behind the published dashboard pages, each a small aggregate of the facts and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subledger.functions import month_of, months_between, safe_divide
from subledger.plans.core import SUBSCRIBER, monthly_price
from subledger.plans.reporting import life, report_months
from subledger.settings import Settings


def mrr_bridge(subscriptions: DataFrame, settings: Settings) -> DataFrame:
    """New, expansion, contraction and churned recurring revenue per month.

    Here a subscription counts at its monthly price in every month it was open, whatever its state today. A customer's
    revenue only moves in months where a subscription opens or ends, so those changes are all that is needed: summed by
    customer and month first, then followed along each customer's months. The first report month opens the books.
    """
    first, last = report_months(settings)
    opened, closed = life(first, last)
    price = monthly_price(F.col("subscription_price"), F.col("charge_interval_days"), settings)
    events = subscriptions.select(
        F.col("shopify_customer_id").alias("customer_id"),
        F.inline(F.array(
            F.struct(opened.alias("report_month"), price.alias("change")),
            F.struct(F.add_months(closed, 1).alias("report_month"), (-price).alias("change")),
        )),
    ).filter(F.col("report_month").between(F.lit(first), F.lit(last)))
    moves = events.groupBy("customer_id", "report_month").agg(F.sum("change").alias("change"))
    until_now = Window.partitionBy("customer_id").orderBy("report_month").rowsBetween(Window.unboundedPreceding, 0)
    after = F.sum("change").over(until_now)
    change, before = F.col("change"), F.col("after") - F.col("change")
    kinds = {
        "new_mrr": (before == 0) & (change > 0),
        "expansion_mrr": (before > 0) & (change > 0),
        "contraction_mrr": (F.col("after") > 0) & (change < 0),
        "churned_mrr": (F.col("after") == 0) & (change < 0),
    }
    return (
        moves.withColumn("after", after)
        .groupBy("report_month")
        .agg(*[F.sum(F.when(kind, change).otherwise(0)).alias(name) for name, kind in kinds.items()])
        .orderBy("report_month")
    )


def active_change(health: DataFrame) -> DataFrame:
    """Active subscriptions against the month before. One row per month, so one window partition will do."""
    before = F.lag("active_subscriptions").over(Window.orderBy("report_month"))
    active = F.col("active_subscriptions")
    return health.select(
        "report_month", "active_subscriptions", (active - before).alias("change"), safe_divide(active - before, before).alias("change_rate")
    ).orderBy("report_month")


def cohort_value(orders: DataFrame, shop_customers: DataFrame) -> DataFrame:
    """Cumulative net revenue per cohort and month since first order, in total and per customer of the cohort.

    Orders are summed by customer and month first; the cohort is the earliest of a customer's few rows.
    """
    placed = F.col("order_created_at_utc")
    monthly = orders.groupBy(F.col("shopify_customer_id").alias("customer_id"), month_of(placed).alias("order_month")).agg(
        F.sum("net_revenue").alias("net_revenue")
    )
    cohort = F.min("order_month").over(Window.partitionBy("customer_id"))
    ids = shop_customers.select(F.col("shopify_customer_id").alias("customer_id"))
    spent = (
        monthly.join(ids, "customer_id", "left_semi")
        .withColumn("cohort_month", cohort)
        .filter(F.col("cohort_month").isNotNull())
        .groupBy("cohort_month", months_between(F.col("cohort_month"), F.col("order_month")).alias("months_since_first_order"))
        .agg(F.sum("net_revenue").alias("net_revenue"), F.count("*").alias("customers_active"))
    )
    by_cohort = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("months_since_first_order") == 0, F.col("customers_active"))).over(by_cohort)
    so_far = by_cohort.orderBy(F.col("months_since_first_order").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    return (
        spent.withColumn("cohort_size", size)
        .withColumn("cumulative_revenue", F.sum("net_revenue").over(so_far))
        .select(
            "cohort_month", "months_since_first_order", "cohort_size", "net_revenue", "cumulative_revenue",
            safe_divide(F.col("cumulative_revenue"), F.col("cohort_size"), 2).alias("revenue_per_customer"),
        )
        .orderBy("cohort_month", "months_since_first_order")
    )


def channel_value(customers: DataFrame) -> DataFrame:
    """Customers and what they spent, by first channel."""
    return (
        customers.groupBy("acquisition_channel")
        .agg(
            F.count("*").alias("customers"),
            F.sum("lifetime_orders").alias("lifetime_orders"),
            F.sum("lifetime_revenue").alias("lifetime_revenue"),
        )
        .withColumn("revenue_per_customer", safe_divide(F.col("lifetime_revenue"), F.col("customers"), 2))
        .orderBy("acquisition_channel")
    )


def channel_conversion(customers: DataFrame) -> DataFrame:
    """Share of the customers of each first channel that subscribe."""
    return (
        customers.groupBy("acquisition_channel")
        .agg(F.count("*").alias("customers"), F.count_if(F.col("customer_type") == SUBSCRIBER).alias("subscribers"))
        .withColumn("conversion_rate", safe_divide(F.col("subscribers"), F.col("customers")))
        .orderBy("acquisition_channel")
    )


def refund_rate(reconciliation: DataFrame) -> DataFrame:
    refunds, gross = F.col("stripe_total_refunds"), F.col("stripe_gross_revenue")
    return reconciliation.select(
        "order_month", "stripe_gross_revenue", "stripe_total_refunds", safe_divide(refunds, gross).alias("refund_rate"),
        F.col("stripe_net_settled").alias("net_revenue_after_returns"),
    ).orderBy("order_month")


def dunning_recovery(charges: DataFrame, settings: Settings) -> DataFrame:
    """Failed charges per month, and how many were followed by a success of the same subscription in time.

    Successes are first reduced to the earliest and latest of each subscription and day; what follows a day is then
    looked up along a list no longer than the calendar, however many charges a subscription has.
    """
    created = F.col("charge_created_at_utc")
    keyed = charges.filter(F.col("subscription_id").isNotNull() & created.isNotNull())
    paid, failed = F.col("is_successful_charge"), F.col("is_failed_charge")
    daily = keyed.groupBy("subscription_id", "charge_date").agg(
        F.min(F.when(paid, created)).alias("first_paid"), F.max(F.when(paid, created)).alias("last_paid")
    )
    later = Window.partitionBy("subscription_id").orderBy("charge_date").rowsBetween(1, Window.unboundedFollowing)
    outlook = daily.select("subscription_id", "charge_date", "last_paid", F.min("first_paid").over(later).alias("next_paid"))
    attempts = keyed.filter(failed).select("subscription_id", "charge_date", "charge_created_at_utc")
    limit = created + F.expr(f"INTERVAL '{int(settings.dunning_days)}' DAY")
    recovered = F.coalesce(F.col("last_paid") > created, F.lit(False)) | F.coalesce(F.col("next_paid") <= limit, F.lit(False))
    return (
        attempts.join(outlook, ["subscription_id", "charge_date"])
        .groupBy(month_of(created).alias("charge_month"))
        .agg(F.count("*").alias("failed_charges"), F.count_if(recovered).alias("recovered_charges"))
        .select("*", safe_divide(F.col("recovered_charges"), F.col("failed_charges")).alias("recovery_rate"))
        .orderBy("charge_month")
    )


def channel_orders(orders: DataFrame) -> DataFrame:
    """First and repeat orders by the channel of the order itself."""
    return (
        orders.groupBy("channel", "is_first_order")
        .agg(F.count("*").alias("orders"), F.sum("net_revenue").alias("net_revenue"))
        .orderBy("channel", "is_first_order")
    )
