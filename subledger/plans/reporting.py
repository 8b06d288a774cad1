"""Monthly reports. Their results have a few rows per month; everything before that is aggregated where it lies."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.functions import flag, month_of, months_between, safe_divide
from subledger.operators import month_deltas, month_spine, running_levels
from subledger.plans.core import charge_totals, first_touch
from subledger.plans.intermediate import MISMATCH, NO_MATCH, ORPHANED, RECONCILED
from subledger.settings import Settings


def customer_months(orders: DataFrame, shop_customers: DataFrame) -> DataFrame:
    """The months in which a customer of the dimension ordered, with the customer's cohort and first channel.

    The same rows as the distinct of the order facts, from one aggregate instead of a join of orders with their own
    totals. A customer's set of months is bounded by the calendar, however many orders there are.
    """
    month = month_of(F.col("order_created_at_utc"))
    per_customer = orders.groupBy(F.col("shopify_customer_id").alias("customer_id")).agg(
        month_of(F.min("order_created_at_utc")).alias("acquisition_cohort_month"),
        first_touch(F.col("channel"), F.col("order_created_at_utc"), F.col("order_id")).alias("acquisition_channel"),
        F.collect_set(month).alias("months"),
        F.count_if(F.col("order_created_at_utc").isNull()).alias("undated"),
    )
    ids = shop_customers.select(F.col("shopify_customer_id").alias("customer_id"))
    months = F.when(F.col("undated") > 0, F.array_append("months", F.lit(None).cast("date"))).otherwise(F.col("months"))
    return per_customer.join(ids, "customer_id", "left_semi").select(
        "customer_id", "acquisition_cohort_month", "acquisition_channel", F.explode(months).alias("order_month")
    )


def cohort_retention(active_months: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Share of each cohort that orders again n months later, if asked within each value of further columns.

    Rows are distinct by customer and month, so counting customers is counting rows. The cohort's size is its own
    month 0; cohorts without one, and customers without a cohort, drop out.
    """
    offset = months_between(F.col("acquisition_cohort_month"), F.col("order_month"))
    counts = (
        active_months.filter(F.col("acquisition_cohort_month").isNotNull())
        .groupBy(*within, F.col("acquisition_cohort_month").alias("cohort_month"), offset.alias("months_since_first_order"))
        .agg(F.count("customer_id").alias("customers_active"))
    )
    return retention_rates(counts, within)


def retention_rates(counts: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Counts of active customers per cohort and month as shares of the cohort, in order."""
    start = F.when(F.col("months_since_first_order") == 0, F.col("customers_active"))
    size = F.max(start).over(Window.partitionBy(*within, "cohort_month"))
    return (
        counts.withColumn("cohort_size", size)
        .filter(F.col("cohort_size").isNotNull())
        .select(
            *within,
            "cohort_month",
            "months_since_first_order",
            "cohort_size",
            "customers_active",
            F.round(F.col("customers_active").cast("double") / F.col("cohort_size"), 4).alias("retention_rate"),
        )
        .orderBy(*within, "cohort_month", "months_since_first_order")
    )


def revenue_reconciliation(reconciled: DataFrame, settings: Settings) -> DataFrame:
    def of_status(status: str) -> Column:
        return F.count_if(F.col("reconciliation_status") == status)

    monthly = reconciled.groupBy("order_month").agg(
        F.sum("shopify_gross_revenue").alias("shopify_revenue"),
        F.count("*").alias("total_orders"),
        F.sum(F.when(F.col("stripe_is_successful"), F.col("stripe_charge_amount")).otherwise(0)).alias("stripe_gross_revenue"),
        F.sum("stripe_refund_amount").alias("stripe_total_refunds"),
        F.sum("stripe_net_settled").alias("stripe_net_settled"),
        of_status(RECONCILED).alias("reconciled_orders"),
        of_status(NO_MATCH).alias("unmatched_orders"),
        of_status(MISMATCH).alias("amount_mismatches"),
        of_status(ORPHANED).alias("orphaned_refunds"),
    )
    variance = F.col("shopify_revenue") - F.col("stripe_gross_revenue")
    share = safe_divide(variance, F.col("shopify_revenue"))
    return monthly.select(
        "order_month",
        "total_orders",
        "shopify_revenue",
        "stripe_gross_revenue",
        "stripe_total_refunds",
        "stripe_net_settled",
        variance.alias("gross_revenue_variance"),
        share.alias("variance_pct"),
        flag(F.abs(share) > F.lit(settings.variance_threshold)).alias("exceeds_variance_threshold"),
        "reconciled_orders",
        "unmatched_orders",
        "amount_mismatches",
        "orphaned_refunds",
        safe_divide(F.col("reconciled_orders"), F.col("total_orders")).alias("reconciliation_rate"),
    ).orderBy("order_month")


def report_months(settings: Settings) -> tuple[dt.date, dt.date]:
    """First and last month with a day both in the report and in the date dimension."""
    first = max(settings.report_start, settings.spine_start)
    last = min(settings.report_end, settings.spine_end - dt.timedelta(days=1))
    return first.replace(day=1), last.replace(day=1)


def life(first: dt.date, last: dt.date) -> tuple[Column, Column]:
    """First and last month a subscription is active in, cut to the report; both null when there is none.

    A subscription is active in a month when it was created by the next month's first midnight, that instant included,
    and was not cancelled by the month's own first midnight. So it is active from the month of creation, or the one
    before when created on a month's first midnight, to the month of cancellation, or the one before likewise.
    """
    created, ended = F.col("subscription_created_at_utc"), F.col("subscription_cancelled_at_utc")

    def month_before(when: Column) -> Column:
        month = month_of(when)
        return F.when(when == month.cast("timestamp_ntz"), F.add_months(month, -1)).otherwise(month)

    opened = F.greatest(month_before(created), F.lit(first))
    closed = F.least(F.coalesce(month_before(ended), F.lit(last)), F.lit(last))
    # greatest passes over a null, but a subscription that was never created is never active.
    lives = created.isNotNull() & (opened <= closed)
    return F.when(lives, opened), F.when(lives, closed)


def subscription_months(subscriptions: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Per month: change of the active count, new and cancelled subscriptions, change of recurring revenue.

    Counts are of distinct subscription ids. Should an id have several rows, their months are merged rather than
    counted twice; a copied row counts once in the counts and each time in the revenue.
    """
    opened, closed = life(first, last)
    lives_in = subscriptions.select(
        "subscription_id",
        month_of(F.col("subscription_created_at_utc")).alias("new_month"),
        month_of(F.col("subscription_cancelled_at_utc")).alias("cancelled_month"),
        opened.alias("opened"),
        closed.alias("closed"),
        "monthly_recurring_revenue",
    )
    # Collapses copies before they meet in one task: an id has at most one row per combination of months.
    rows = lives_in.groupBy("subscription_id", "new_month", "cancelled_month", "opened", "closed").agg(
        F.coalesce(F.sum("monthly_recurring_revenue"), F.lit(0)).alias("revenue")
    )

    by_id = Window.partitionBy("subscription_id")
    covered = F.max("closed").over(by_id.orderBy(F.col("opened").asc_nulls_last(), "closed").rowsBetween(Window.unboundedPreceding, -1))
    identified = F.col("subscription_id").isNotNull()

    def first_in(month: str) -> Column:
        rank = F.row_number().over(Window.partitionBy("subscription_id", month).orderBy("opened", "closed", "new_month", "cancelled_month"))
        return F.when(identified & (rank == 1), F.col(month))

    marked = rows.select(
        "opened",
        "closed",
        "revenue",
        covered.alias("covered"),
        identified.alias("identified"),
        first_in("new_month").alias("new_month"),
        first_in("cancelled_month").alias("cancelled_month"),
    )
    uncovered = F.col("covered").isNull() | (F.col("opened") > F.col("covered"))
    counted_from = F.when(
        F.col("identified"),
        F.when(uncovered, F.col("opened")).when(F.col("closed") > F.col("covered"), F.add_months("covered", 1)),
    )
    after = F.add_months("closed", 1)
    counted = marked.withColumn("counted_from", counted_from)
    return month_deltas(
        counted,
        [
            {"month": F.col("counted_from"), "active": F.lit(1)},
            {"month": F.col("opened"), "revenue": F.col("revenue")},
            {"month": after, "active": F.when(F.col("counted_from").isNotNull(), -1), "revenue": -F.col("revenue")},
            {"month": F.col("new_month"), "new": F.lit(1)},
            {"month": F.col("cancelled_month"), "cancelled": F.lit(1)},
        ],
        ["active", "new", "cancelled", "revenue"],
    )


def subscription_health(subscriptions: DataFrame, charges: DataFrame, settings: Settings) -> DataFrame:
    first, last = report_months(settings)
    months = month_spine(subscriptions.sparkSession, first, last)
    deltas = subscription_months(subscriptions, first, last)
    levels = running_levels(months, deltas, "report_month", levels=["active", "revenue"], flows=["new", "cancelled"])
    payments = charge_totals(charges, "charge_month").withColumnRenamed("charge_month", "report_month")
    return (
        levels.join(payments, "report_month", "left")
        .select(
            "report_month",
            F.col("active").alias("active_subscriptions"),
            F.col("new").alias("new_subscriptions"),
            F.col("cancelled").alias("cancelled_subscriptions"),
            F.col("revenue").alias("monthly_recurring_revenue"),
            safe_divide(F.col("cancelled"), F.col("active")).alias("churn_rate"),
            (F.col("new") - F.col("cancelled")).alias("net_subscription_change"),
            F.coalesce("total_charge_attempts", F.lit(0)).alias("total_charge_attempts"),
            F.coalesce("successful_charges", F.lit(0)).alias("successful_charges"),
            F.coalesce("failed_charges", F.lit(0)).alias("failed_charges"),
            safe_divide(F.col("failed_charges"), F.col("total_charge_attempts")).alias("payment_failure_rate"),
            F.coalesce("total_charged_revenue", F.lit(0)).alias("charged_revenue"),
        )
        .orderBy("report_month")
    )
