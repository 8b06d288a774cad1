"""Distinct customers and line values as sketches that merge: kept per channel, month and product, rolled up by merging.

A cell holds a theta sketch of its customers, a KLL sketch of its line values and the exact number of lines. Coarser groups
come from finer ones, so the lines are read once however many groupings are asked for, and a new day only adds cells. Who came
back is an intersection of two sketches: customers first seen in one month, and customers of another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.functions import month_of, months_between

#: Log2 of the entries of a theta sketch, and the size of a KLL sketch.
THETA_LOG, KLL_SIZE = 12, 400
#: Relative error of a count of distinct values that is hardly ever exceeded: four standard errors. Counts below the entries
#: of a sketch are exact.
DISTINCT_ERROR = 4 / 2 ** (THETA_LOG / 2)
#: The same for the rank of a quantile, as a share of the values: four times what 99 of 100 stay below.
RANK_ERROR = 4 * 0.0075

GRAIN = ["channel", "order_month", "product_id"]


def order_lines(orders: DataFrame, line_items: DataFrame) -> DataFrame:
    """Lines of valid orders with their grain, customer and value."""
    placed = orders.select("order_id", "channel", month_of(F.col("order_created_at_utc")).alias("order_month"), "shopify_customer_id")
    return placed.join(line_items.select("order_id", "product_id", F.col("net_line_amount").alias("value")), "order_id").drop("order_id")


def cells(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*GRAIN).agg(
        F.count("*").alias("lines"),
        F.theta_sketch_agg("shopify_customer_id", THETA_LOG).alias("customers"),
        F.kll_sketch_agg_double(F.col("value").cast("double"), F.lit(KLL_SIZE)).alias("amounts"),
    )


def rolled_up(finer: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cells of a coarser grouping."""
    return finer.groupBy(*by).agg(
        F.sum("lines").alias("lines"), F.theta_union_agg("customers", THETA_LOG).alias("customers"),
        F.kll_merge_agg_double("amounts", F.lit(KLL_SIZE)).alias("amounts"),
    )


def figures(groups: DataFrame) -> DataFrame:
    """The estimates that the sketches give."""
    return groups.select(
        *[c for c in groups.columns if c not in ("customers", "amounts")],
        F.theta_sketch_estimate("customers").alias("customers_estimate"),
        F.kll_sketch_get_quantile_double("amounts", F.lit(0.5)).alias("median_estimate"),
    )


def checked_rollup(lines: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact figures of a grouping beside whether the estimates from merged cells keep their bounds.

    Customers are counted from distinct rows. The median is checked by its rank: how many values lie below the estimate and
    how many not above it must enclose the middle, within the bound. So no group's values come together.
    """
    estimates = figures(rolled_up(rolled_up(cells(lines), GRAIN[:2]), by))
    distinct = lines.select(*by, "shopify_customer_id").distinct().groupBy(*by).agg(F.count("shopify_customer_id").alias("customers"))
    value = F.col("value").cast("double")
    ranks = _beside(lines.select(*by, "value"), estimates.select(*by, "median_estimate"), by).groupBy(*by).agg(
        F.count("value").alias("_n"), F.count_if(value < F.col("median_estimate")).alias("_below"), F.count_if(value <= F.col("median_estimate")).alias("_upto")
    )
    joined = _beside(_beside(estimates, distinct, by), ranks, by)
    apart = F.abs(F.col("customers_estimate") - F.col("customers"))
    return joined.select(
        *by, "lines", "customers",
        (apart <= F.col("customers") * DISTINCT_ERROR).alias("customers_within_bound"),
        ((F.col("_below") <= (0.5 + RANK_ERROR) * F.col("_n")) & (F.col("_upto") >= (0.5 - RANK_ERROR) * F.col("_n"))).alias("median_within_bound"),
    )


def _beside(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """An inner join on equal groups, null being one; ``right`` has a row per group, so Spark may broadcast it by its size and
    adaptive execution may split a large group of ``left``."""
    renamed = right.withColumnsRenamed({c: f"_of_{c}" for c in by})
    met = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    return left.join(renamed, met).drop(*[f"_of_{c}" for c in by])


def checked_retention(active_months: DataFrame) -> DataFrame:
    """Cohort retention from one sketch per cohort and one per month, beside the exact counts.

    ``active_months`` has a row per customer and month with the customer's cohort. A cohort meets the months after it by
    equality, from the report's calendar: no pairing of customers.
    """
    known = active_months.filter("acquisition_cohort_month is not null and order_month is not null")
    sketch = F.theta_sketch_agg("customer_id", THETA_LOG)
    cohorts = known.groupBy(F.col("acquisition_cohort_month").alias("cohort_month")).agg(sketch.alias("members"), F.max("order_month").alias("until"))
    months = known.groupBy("order_month").agg(sketch.alias("active"))
    offset = months_between(F.col("cohort_month"), F.col("order_month")).cast("bigint").alias("months_since_first_order")
    every = F.explode(F.sequence("cohort_month", "until", F.expr("interval 1 month"))).alias("order_month")
    met = cohorts.select("cohort_month", "members", every).join(months, "order_month")
    estimates = met.select("cohort_month", offset, F.theta_sketch_estimate(F.theta_intersection("members", "active")).alias("estimate"), F.theta_sketch_estimate("members").alias("size"))
    exact = known.groupBy(F.col("acquisition_cohort_month").alias("cohort_month"), offset_of_known()).agg(F.count("customer_id").alias("customers_active"))
    # The error of an intersection goes by the larger of the two sets.
    return exact.join(estimates, ["cohort_month", "months_since_first_order"], "left").join(
        months.select(F.col("order_month").alias("_month"), F.theta_sketch_estimate("active").alias("_active")),
        F.col("_month") == F.add_months("cohort_month", F.col("months_since_first_order").cast("int")), "left",
    ).select(
        "cohort_month", "months_since_first_order", "customers_active",
        (F.abs(F.col("estimate") - F.col("customers_active")) <= DISTINCT_ERROR * F.greatest("size", "_active")).alias("within_bound"),
    )


def offset_of_known():
    return months_between(F.col("acquisition_cohort_month"), F.col("order_month")).cast("bigint").alias("months_since_first_order")
