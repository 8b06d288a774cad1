"""Keys that hold too many rows for one task: find them, and split the work on them without changing results."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subledger.session import materialized

# Salts per task-sized piece of a key: with only one, two pieces would often land in the same partition.
_SALTS_PER_PIECE = 4
# Keys a sketch can follow, the most that Spark's allows, and the least that is worth the name.
_MOST_TRACKED, _LEAST_TRACKED = 1_000_000, 1024
# A sketch that follows m keys misjudges a count by less than four rows in m.
_SKETCH_ERROR = 4


@dataclass(frozen=True)
class HotKeys:
    """``keys`` has a row per hot key: the key and its number of ``salts``. None if there are none."""

    column: str
    keys: DataFrame | None = None
    pieces: int = 0

    def __bool__(self) -> bool:
        return self.keys is not None

    def marked(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_salts``: those of the row's key, null for keys that are not hot. Null is a key like any other.

        The hot keys are a written table of at most rows / ``rows_per_task`` rows; Spark decides by its size how to join.
        """
        keys = self.keys.select(F.col("key").alias("_hot"), F.col("salts").alias("_salts"))
        return df.join(keys, F.col(self.column).eqNullSafe(F.col("_hot")), "left").drop("_hot")

    def salted(self, df: DataFrame, spread: Sequence[str]) -> DataFrame:
        """``df`` with ``_salt``: below the salts of its key for rows of a hot key, 0 for others."""
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.col("_salts").cast("bigint"))
        return self.marked(df).withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("int")).drop("_salts")

    def repeated(self, df: DataFrame) -> DataFrame:
        """``df`` with rows of a hot key repeated for every ``_salt`` that it may have on the other side of a join. A null
        key meets nothing there and stays single. ``_salts`` is kept.
        """
        salts = F.when(F.col(self.column).isNotNull(), F.col("_salts"))
        every = F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1)
        return self.marked(df).withColumn("_salt", F.explode(every))


def find_hot_keys(df: DataFrame, column: str, rows_per_task: int) -> HotKeys:
    """Keys (null included) with more rows than one task should take.

    A table with no more rows than that has none, which its row count tells without reading a column. Otherwise one pass
    over the column fills a heavy-hitter sketch per task, and only the sketches travel. A sketch follows four times as
    many keys as can be hot; beyond the size that this allows, keys count as hot from four millionths of all rows on.
    The keys steer how work is split; no result depends on them.
    """
    total = df.count()
    if total <= rows_per_task:
        return HotKeys(column)
    tracked = min(_MOST_TRACKED, max(_LEAST_TRACKED, 2 * _SKETCH_ERROR * math.ceil(total / rows_per_task)))
    least = max(rows_per_task, math.ceil(_SKETCH_ERROR * total / _MOST_TRACKED))
    sketch = df.agg(F.expr(f"approx_top_k({column}, {min(tracked, total // least + 1)}, {tracked})").alias("top"))
    found = sketch.select(F.inline("top").alias("key", "rows")).filter(F.col("rows") > least)
    salts = _SALTS_PER_PIECE * F.greatest(F.lit(2), F.ceil(F.col("rows") / rows_per_task))
    keys = materialized(found.select("key", "rows", salts.cast("int").alias("salts")))
    rows = keys.agg(F.sum("rows")).first()[0]
    return HotKeys(column, keys, max(2, math.ceil(rows / rows_per_task))) if rows else HotKeys(column)


def number_rows(df: DataFrame, order_by: Sequence[str], out: str, hot: HotKeys) -> DataFrame:
    """``row_number`` per key, with a hot key's rows numbered by many tasks. The last of ``order_by`` is unique.

    The order columns of the hot rows are range-partitioned on (key, order), so one key spans many equal slices in
    order; each slice is numbered on its own and shifted by the rows of the slices before it. The numbers then join the
    hot rows by the unique column, evenly spread. The slices, key and order columns only, are written once: sizes and rows
    see the same slice boundaries even if an executor is lost in between.
    """
    key, order, unique = hot.column, [F.col(c).asc_nulls_last() for c in order_by], order_by[-1]
    whole = F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("bigint")
    if not hot:
        return df.withColumn(out, whole)

    marked = hot.marked(df)
    cold = marked.filter("_salts is null").drop("_salts").withColumn(out, whole)
    sliced = materialized(
        hot.marked(df.select(key, *order_by)).filter("_salts is not null").drop("_salts")
        .repartitionByRange(hot.pieces, F.col(key).asc_nulls_last(), *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    # One row per slice and key in it: at most one per slice and one per hot key, whatever the data.
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = sliced.groupBy(key, "_slice").agg(F.count("*").alias("_n")).select(
        F.col(key).alias("_key"), F.col("_slice").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift")
    )
    within = F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*order))
    numbers = (
        sliced.withColumn("_within", within)
        .join(shift, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_of")))
        .select(F.col(unique).alias("_unique"), (F.col("_within") + F.col("_shift")).alias(out))
    )
    numbered = marked.filter("_salts is not null").join(numbers, F.col(unique).eqNullSafe(F.col("_unique")))
    return cold.unionByName(numbered.select(*cold.columns))


def left_join_many(left: DataFrame, right: DataFrame, hot: HotKeys, spread: Sequence[str]) -> DataFrame:
    """``left`` (one row per key) left-joined to a right side where some keys may have very many rows.

    Adaptive execution cannot split the right side of a left join. Here the right rows of a hot key get one of several
    salts, as many as that key needs, and its left row is repeated once per salt. A hot key has right rows by definition,
    so the repeats that meet none are dropped and nothing else changes. The salt depends only on the input split and the
    row's ``spread`` columns: a repeated task gives the same salts, and exact copies of a row are still spread.
    """
    if not hot:
        return left.join(right, hot.column, "left")
    split = right.withColumn("_split", F.spark_partition_id())
    salted = hot.salted(split, ["_split", *spread]).drop("_split").withColumn("_met", F.lit(True))
    joined = hot.repeated(left).join(salted, [hot.column, "_salt"], "left")
    single = F.col("_salts").isNull() | F.col(hot.column).isNull()
    return joined.filter(single | F.col("_met")).drop("_salt", "_salts", "_met")


def left_join_few(left: DataFrame, right: DataFrame, hot: HotKeys, spread: Sequence[str]) -> DataFrame:
    """``left`` with very many rows of some keys, left-joined to a right side with few rows per key.

    Left rows of a hot key are spread over its salts and the key's right rows are repeated for each. Null keys meet
    nothing and are spread all the same.
    """
    if not hot:
        return left.join(right, hot.column, "left")
    repeated = hot.repeated(right).drop("_salts")
    return hot.salted(left, spread).join(repeated, [hot.column, "_salt"], "left").drop("_salt")
