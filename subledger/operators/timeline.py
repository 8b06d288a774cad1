"""Rows of a key in the order of time: last known values, neighbours, versions with validity, and joins as of a time.

Each works on windows by key. Rows of keys too large for one task are cut in range slices of (key, time): a slice is worked
on by itself, and what it needs from the slices before or after it is one value per slice and key, which is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.operators.dedup import row_digest
from subledger.operators.skew import HotKeys, find_hot_keys
from subledger.session import materialized


def _split(df: DataFrame, order: Sequence[str], hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """Rows of other keys, and the rows of hot keys with the number of their slice, written once."""
    marked = hot.marked(df)
    sliced = (
        marked.filter("_salts is not null").drop("_salts").repartitionByRange(hot.pieces, F.col(hot.column).asc_nulls_last(), *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    return marked.filter("_salts is null").drop("_salts"), materialized(sliced)


def _joined_ends(sliced: DataFrame, key: str, ends: DataFrame, forward: bool) -> DataFrame:
    """``sliced`` with ``_carry``, the ``_end`` of the nearest slice of the key before (or after) that has one."""
    by = Window.partitionBy(key)
    order = by.orderBy("_slice" if forward else F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col(key).alias("_of_key"), F.col("_slice").alias("_of"), F.last("_end", ignorenulls=True).over(order).alias("_carry"))
    met = F.col(key).eqNullSafe(F.col("_of_key")) & (F.col("_slice") == F.col("_of"))
    return sliced.join(carried, met, "left").drop("_of_key", "_of", "_slice")


def carry_forward(df: DataFrame, order: Sequence[str], column: str, hot: HotKeys) -> DataFrame:
    """``df`` with each null of ``column`` replaced by the last value before it in the key's ``order``.

    Order columns must not be null. Rows that tie in all of them see each other's values in an arbitrary order.
    """
    key = hot.column
    so_far = F.last(column, ignorenulls=True)
    if not hot:
        return df.withColumn(column, so_far.over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    cold, sliced = _split(df, order, hot)
    cold = cold.withColumn(column, so_far.over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    last = F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))
    ends = sliced.groupBy(key, "_slice").agg(last.alias("_end"))
    within = so_far.over(Window.partitionBy(key, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    filled = _joined_ends(sliced.withColumn(column, within), key, ends, True)
    return cold.unionByName(filled.withColumn(column, F.coalesce(column, "_carry")).select(*cold.columns))


def neighbour(df: DataFrame, order: Sequence[str], column: str, out: str, hot: HotKeys, step: int) -> DataFrame:
    """``df`` with ``out``: ``column`` of the key's row before (step -1) or after (step 1); null at the end. ``column`` must
    not be null."""
    key, shift = hot.column, F.lag if step < 0 else F.lead
    if not hot:
        return df.withColumn(out, shift(column).over(Window.partitionBy(key).orderBy(*order)))
    cold, sliced = _split(df, order, hot)
    cold = cold.withColumn(out, shift(column).over(Window.partitionBy(key).orderBy(*order)))
    edge = (F.max_by if step < 0 else F.min_by)(column, F.struct(*order))
    ends = sliced.groupBy(key, "_slice").agg(edge.alias("_end"))
    within = shift(column).over(Window.partitionBy(key, "_slice").orderBy(*order))
    shifted = _joined_ends(sliced.withColumn(out, within), key, ends, step < 0)
    return cold.unionByName(shifted.withColumn(out, F.coalesce(out, "_carry")).select(*cold.columns))


def as_of_join(
    events: DataFrame, versions: DataFrame, key: str, event_time: str, version_time: str, values: Sequence[str],
    rows_per_task: int, strictly_before: bool = False,
) -> DataFrame:
    """``events`` with the ``values`` that were valid for their ``key`` at ``event_time``: those of the latest version not
    after it, or before it if ``strictly_before``; null where there was none.

    Both sides are merged in the order of time and the last version is carried forward, so a key with very many of both
    makes no pairs. Events without a key or a time stay, without values; such versions are never valid. Of versions of
    one time the one of the greatest digest of its values counts. Values named like event columns are not allowed.
    """
    clash = set(values) & set(events.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    known = F.col(key).isNotNull() & F.col(event_time).isNotNull()
    marked = versions.filter(F.col(key).isNotNull() & F.col(version_time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(version_time).alias("_at"), F.lit(int(strictly_before)).alias("_side"),
        row_digest(versions.select(*values)).alias("_tie"), F.struct(*values).alias("_version"),
    )
    none = F.lit(None).cast(marked.schema["_version"].dataType)
    asked = events.filter(known).select(
        F.col(key).alias("_key"), F.col(event_time).alias("_at"), F.lit(int(not strictly_before)).alias("_side"), F.lit("").alias("_tie"),
        none.alias("_version"), F.struct(*events.columns).alias("_event"),
    )
    both = asked.unionByName(marked.withColumn("_event", F.lit(None).cast(asked.schema["_event"].dataType)))
    hot = find_hot_keys(both.select("_key"), "_key", rows_per_task)
    joined = carry_forward(both, ["_at", "_side", "_tie"], "_version", hot).filter("_event is not null").select("_event.*", "_version.*")
    return joined.unionByName(events.filter(~known).select("*", none.alias("_version")).select(*events.columns, "_version.*"))


def versions(changes: DataFrame, key: str, when: str, attributes: Sequence[str], rows_per_task: int) -> DataFrame:
    """Type-2 rows: key, ``attributes``, valid_from, valid_to (exclusive; null while valid).

    A row of ``changes`` says what the attributes were from ``when`` on. Rows that change nothing, told by a digest, do not
    start a version. Of rows of one time the one of the greatest digest counts; rows without a key or time are left out.
    """
    digest = row_digest(changes.select(*attributes))
    known = changes.filter(F.col(key).isNotNull() & F.col(when).isNotNull())
    # One row per key and time, chosen by tasks ahead of the shuffle.
    last = known.groupBy(F.col(key), F.col(when).alias("valid_from")).agg(F.max(F.struct(digest.alias("digest"), *attributes)).alias("_row"))
    points = last.select(key, "valid_from", F.col("_row.digest").alias("_digest"), *[F.col(f"_row.{a}").alias(a) for a in attributes])
    hot = find_hot_keys(known.select(key), key, rows_per_task)
    compared = neighbour(points, ["valid_from"], "_digest", "_before", hot, -1)
    changed = compared.filter(~F.col("_digest").eqNullSafe(F.col("_before"))).drop("_digest", "_before")
    return neighbour(changed, ["valid_from"], "valid_from", "valid_to", hot, 1).select(key, *attributes, "valid_from", "valid_to")


def with_late_changes(
    history: DataFrame, observed: DataFrame, late: DataFrame, key: str, when: str, attributes: Sequence[str], rows_per_task: int
) -> DataFrame:
    """``history``, made of ``observed``, with ``late`` changes taken in: they split or move the intervals they fall into.

    Only keys with late changes are computed anew. From what was observed, not from their intervals: an observation that
    changed nothing then may end an interval now.
    """
    touched = materialized(late.filter(F.col(key).isNotNull()).select(F.col(key).alias("_touched")).distinct())
    among = lambda df, how: df.join(touched, F.col(key) == F.col("_touched"), how)
    columns = [key, when, *attributes]
    redone = versions(among(observed.select(*columns), "left_semi").unionByName(late.select(*columns)), key, when, attributes, rows_per_task)
    return among(history, "left_anti").unionByName(redone)


def valid_at(history: DataFrame, instant: Column) -> DataFrame:
    """The version of each key that was valid at an instant."""
    return history.filter((F.col("valid_from") <= instant) & (F.col("valid_to").isNull() | (F.col("valid_to") > instant)))
