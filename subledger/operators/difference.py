"""What differs between two builds of a table, found through digests of its parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.operators.dedup import row_digest

ADDED, REMOVED, CHANGED = "added", "removed", "changed"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def digest_tree(df: DataFrame, keys: Sequence[str], part: str, buckets: int = 64) -> DataFrame:
    """Leaves of the tree: part (a month, say), bucket of the keys, number of rows and two sums of row digests.

    Sums do not depend on order, and repeated rows count. To be written beside the table when it is built: one row per part
    and bucket, whatever the table's size.
    """
    digest = row_digest(df)
    halves = [F.conv(F.substr(digest, F.lit(at), F.lit(15)), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    return df.select(F.col(part).alias("part"), _bucket(keys, buckets), *[h.alias(f"h{n}") for n, h in enumerate(halves)]).groupBy("part", "bucket").agg(
        F.count("*").alias("rows"), F.sum("h0").cast("decimal(38,0)").alias("sum_0"), F.sum("h1").cast("decimal(38,0)").alias("sum_1")
    )


def differing_leaves(before: DataFrame, after: DataFrame) -> DataFrame:
    """(part, bucket) of the leaves that differ; parts whose own sums agree are not looked into."""
    def signed(tree: DataFrame, sign: int) -> DataFrame:
        return tree.select("part", "bucket", *[(sign * F.col(c)).alias(c) for c in ("rows", "sum_0", "sum_1")])

    both = signed(before, -1).unionByName(signed(after, 1))
    sums = [F.sum(c).alias(c) for c in ("rows", "sum_0", "sum_1")]
    apart = (F.col("rows") != 0) | (F.col("sum_0") != 0) | (F.col("sum_1") != 0)
    leaves = both.groupBy("part", "bucket").agg(*sums).filter(apart)
    return leaves.select("part", "bucket")


def row_changes(
    before: DataFrame, after: DataFrame, trees: tuple[DataFrame, DataFrame], keys: Sequence[str], part: str, buckets: int = 64
) -> DataFrame:
    """keys, change (added, removed, changed), column, before, after, copies: what turns one build into the other.

    Rows that both builds have as often cancel out. What is left of a key on one side only was added or removed, ``copies``
    times (column null); where each side has one row left, each column that differs is a row (values as text). Keys with
    more rows left, which are repeated rows, count as removed and added. Only parts with a differing leaf are read: their
    values are put into the plan as a filter (as many as there are parts), which prunes partitions; other buckets are
    dropped ahead of any shuffle.
    """
    leaves = [(r["part"], r["bucket"]) for r in differing_leaves(*trees).collect()]  # at most parts x buckets
    parts = sorted({p for p, _ in leaves if p is not None})
    wanted = F.col(part).isin(parts) if parts else F.lit(False)
    if any(p is None for p, _ in leaves):
        wanted = wanted | F.col(part).isNull()
    numbers = sorted({b for _, b in leaves})

    def rows(df: DataFrame, sign: int) -> DataFrame:
        found = df.filter(wanted)
        if len(numbers) < buckets:
            found = found.filter(_bucket(keys, buckets).isin(numbers) if numbers else F.lit(False))
        return found.withColumns({"_digest": row_digest(found), "_sign": F.lit(sign)})

    columns = [c for c in after.columns if c not in keys]
    both = rows(before, -1).unionByName(rows(after, 1))
    # Copies of a row are counted where they lie; a key repeated a million times sends one row per task.
    left = both.groupBy(*keys, "_digest").agg(F.sum("_sign").alias("n"), *[F.any_value(c).alias(c) for c in columns]).filter("n <> 0")
    values = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    gone = lambda sign: F.sum(F.greatest(F.lit(0), sign * F.col("n")))
    by_key = left.groupBy(*keys).agg(
        gone(-1).alias("removed"), gone(1).alias("added"),
        F.max(F.when(F.col("n") < 0, values)).alias("old"), F.max(F.when(F.col("n") > 0, values)).alias("new"),
    )
    one = (F.col("removed") == 1) & (F.col("added") == 1)

    def row(change: str, column: Column, old: Column, new: Column, copies: Column) -> Column:
        return F.struct(
            F.lit(change).alias("change"), column.cast("string").alias("column"), old.cast("string").alias("before"),
            new.cast("string").alias("after"), copies.cast("bigint").alias("copies"),
        )

    none = F.lit(None)
    pairs = F.filter(F.array(*[row(CHANGED, F.lit(c), F.col("old")[c], F.col("new")[c], F.lit(1)) for c in columns]), lambda r: ~r["before"].eqNullSafe(r["after"]))
    sides = F.filter(
        F.array(row(REMOVED, none, none, none, F.col("removed")), row(ADDED, none, none, none, F.col("added"))), lambda r: r["copies"] > 0
    )
    return by_key.select(*keys, F.explode(F.when(one, pairs).otherwise(sides)).alias("_c")).select(*keys, "_c.*")
