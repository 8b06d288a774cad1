"""Generated calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def day_spine(bounds: DataFrame) -> DataFrame:
    """One row per day from ``start`` up to but not including ``end`` of a one-row frame; empty when end <= start."""
    last = F.greatest(F.col("start"), F.date_sub("end", 1))  # keeps the sequence valid where the filter removes it
    days = F.sequence(F.col("start"), last, F.expr("INTERVAL 1 DAY"))
    return bounds.filter(F.col("start") < F.col("end")).select(F.explode(days).alias("date_day"))


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return day_spine(spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end")))


def month_spine(spark: SparkSession, first: dt.date, last: dt.date, name: str = "report_month") -> DataFrame:
    """One row per month from ``first`` to ``last``, both month starts, both included."""
    months = F.sequence(F.lit(first), F.lit(max(first, last)), F.expr("INTERVAL 1 MONTH"))
    return spark.range(1 if first <= last else 0).select(F.explode(months).alias(name))
