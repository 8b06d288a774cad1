"""How many intervals are open in each month, without pairing intervals with months.

An interval adds one in its first month and takes one off after its last; a running sum over the months gives the level.
Each interval so costs two small events however long it is, and the events of a task collapse to one row per month
before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_deltas(df: DataFrame, events: Sequence[dict[str, Column]], measures: Sequence[str]) -> DataFrame:
    """Sum per month over the events of every row. An event names its ``month`` and some of the measures."""
    structs = [
        F.struct(e["month"].alias("month"), *[e.get(m, F.lit(None)).alias(m) for m in measures])
        for e in _same_types(df, events, measures)
    ]
    rows = df.select(F.inline(F.array(*structs))).filter(F.col("month").isNotNull())
    return rows.groupBy("month").agg(*[F.sum(m).alias(m) for m in measures])


def _same_types(df: DataFrame, events: Sequence[dict[str, Column]], measures: Sequence[str]) -> list[dict[str, Column]]:
    """Give every measure one type over all events, as the elements of an array must agree."""
    types = {}
    for m in measures:
        given = next(e[m] for e in events if m in e)
        types[m] = df.select(given.alias(m)).schema[m].dataType
    return [
        {"month": e["month"], **{m: (e[m] if m in e else F.lit(None)).cast(types[m]) for m in measures}} for e in events
    ]


def running_levels(months: DataFrame, deltas: DataFrame, month: str, levels: Sequence[str], flows: Sequence[str]) -> DataFrame:
    """Months with the running sums of ``levels`` and the plain values of ``flows``; 0 where nothing happened.

    The running window has one partition on purpose: its input is the list of report months.
    """
    until_now = Window.orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    joined = months.join(deltas.withColumnRenamed("month", month), month, "left")
    zero = F.lit(0)
    return joined.select(
        month,
        *[F.coalesce(F.sum(c).over(until_now), zero).alias(c) for c in levels],
        *[F.coalesce(F.col(c), zero).alias(c) for c in flows],
    )
