"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stand for "no value" and "next column" in a digest; neither occurs in the systems' text.
_NOTHING, _NEXT = "\x1e", "\x1f"


def row_digest(df: DataFrame, skip: Sequence[str] = ()) -> Column:
    """A digest of all columns but ``skip``; fractions count in whole hundredths, so that any engine can repeat it."""
    def text(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column * 100).try_cast("bigint")
        return F.coalesce(column.cast("string"), F.lit(_NOTHING))

    return F.md5(F.concat_ws(_NEXT, *[text(f) for f in df.schema if f.name not in skip]))


def keep_first(df: DataFrame, keys: Sequence[str], leading: Sequence[Column] = (), skip: Sequence[str] = ()) -> DataFrame:
    """The first row of each key in the order of ``leading``; ties go to the smallest digest of all columns but ``skip``.

    Rows that still tie are equal, so the survivor is the same on every run and for every consumer. The digest is computed
    before the shuffle: only it and the columns that a consumer uses travel. Spark turns ``row_number() = 1`` into a group
    limit that runs before the shuffle as well, so each task sends at most one row per key and a key with many copies costs
    no more than any other.
    """
    digested = df.withColumn("_digest", row_digest(df, skip))
    window = Window.partitionBy(*keys).orderBy(*leading, "_digest")
    return digested.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank", "_digest")
