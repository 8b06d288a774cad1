"""One-to-one pairs of rows that agree on a key, nearly on an amount, and nearly on a time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.operators.skew import find_hot_keys, number_rows
from subledger.session import materialized


@dataclass(frozen=True)
class Side:
    """Which columns of a table are its id (unique), key, time and amount."""

    rows: DataFrame
    id: str
    key: str
    time: str
    amount: str

    def known(self) -> DataFrame:
        """Rows that can match, and the class each is in: all that differ in their id only."""
        found = self.rows.select(
            F.col(self.id).alias("id"), F.col(self.key).alias("key"), F.col(self.time).alias("time"), F.col(self.amount).alias("amount")
        ).dropna()
        return found.withColumn("class", F.concat_ws("|", "key", F.col("time").cast("string"), F.col("amount").cast("string")))


# The order in which pairs are taken: the nearest in amount, then in time, then a fixed one.
_ORDER = ["amount_gap", "seconds_gap", "l_time", "l_amount", "r_time", "r_amount", "l_class", "r_class"]


def match_one_to_one(left: Side, right: Side, max_amount: Column, max_seconds: int, rows_per_task: int) -> DataFrame:
    """Pairs (left_id, right_id, amount_gap, seconds_gap), each id in one at most.

    Pairs have the same key, amounts at most ``max_amount`` (positive) apart and times at most ``max_seconds``. They are
    those a greedy choice takes: of all possible pairs the one with the smallest amount gap, then time gap, then earlier
    left and right time, smaller amounts, smaller ids; and so on with the rows left. Rows with a null in any of the four
    columns match nothing. With an empty side there are no pairs.

    Rows that differ in their id only are one class with a count, so that repeated payments make no pairs of rows; classes
    meet through neighbouring buckets of time and amount. Then all pairs of classes that are each other's best are taken at
    once, as often as the smaller count allows, again and again until none is left; the numbers within the classes tell
    which rows that pairs. Rounds are as many as there are pairs that wait for one another, usually a few.
    """
    sides = [materialized(s.known()) for s in (left, right)]
    pairs = materialized(_candidates(*[_classes(s, p) for s, p in zip(sides, "lr")], max_amount, max_seconds))
    rounds, live = [], pairs
    while not live.isEmpty():
        taken = materialized(_mutual_best(live))
        rounds.append(taken)
        live = materialized(_left_over(live, taken))
    numbered = [
        number_rows(s, ["id"], "rank", find_hot_keys(s.select("class"), "class", rows_per_task)).select(
            F.col("class").alias(f"{p}_class"), F.col("rank").alias(f"{p}_rank"), F.col("id").alias(name)
        )
        for s, p, name in zip(sides, "lr", ("left_id", "right_id"))
    ]
    if not rounds:
        rounds.append(_mutual_best(pairs))
    taken = rounds[0]
    for more in rounds[1:]:
        taken = taken.unionByName(more)
    each = taken.select("*", F.explode(F.sequence(F.lit(1), F.col("many"))).alias("_n")).select(
        "l_class", "r_class", (F.col("l_used") + F.col("_n")).alias("l_rank"), (F.col("r_used") + F.col("_n")).alias("r_rank"), "amount_gap", "seconds_gap"
    )
    met = each.join(numbered[0], ["l_class", "l_rank"]).join(numbered[1], ["r_class", "r_rank"])
    return met.select("left_id", "right_id", "amount_gap", "seconds_gap")


def _classes(rows: DataFrame, side: str) -> DataFrame:
    counted = rows.groupBy("class", "key", "time", "amount").agg(F.count("*").alias("free"))
    return counted.select("key", *[F.col(c).alias(f"{side}_{c}") for c in ("class", "time", "amount", "free")], F.lit(0).cast("bigint").alias(f"{side}_used"))


def _candidates(left: DataFrame, right: DataFrame, max_amount: Column, max_seconds: int) -> DataFrame:
    """Pairs of classes near enough. A right class stands in its bucket and the eight around it, a left one in its own."""
    def seconds(time: str) -> Column:
        return F.unix_seconds(F.to_utc_timestamp(F.col(time).cast("timestamp"), "UTC"))

    width = max(1, max_seconds)
    buckets = {s: (F.floor(seconds(f"{s}_time") / width), F.floor(F.col(f"{s}_amount") / max_amount)) for s in "lr"}
    beside = F.array(*[F.lit(n) for n in (-1, 0, 1)])
    own = left.select("*", buckets["l"][0].alias("_t"), buckets["l"][1].alias("_a"))
    around = right.select("*", F.explode(F.transform(beside, lambda n: buckets["r"][0] + n)).alias("_t"))
    around = around.select("*", F.explode(F.transform(beside, lambda n: buckets["r"][1] + n)).alias("_a"))
    gaps = own.join(around, ["key", "_t", "_a"]).select(
        *[f"{s}_{c}" for s in "lr" for c in ("class", "time", "amount", "free", "used")],
        F.abs(F.col("l_amount") - F.col("r_amount")).alias("amount_gap"), F.abs(seconds("l_time") - seconds("r_time")).alias("seconds_gap"),
    )
    return gaps.filter((F.col("amount_gap") <= max_amount) & (F.col("seconds_gap") <= max_seconds))


def _mutual_best(live: DataFrame) -> DataFrame:
    """The pairs that come first for both their classes, and how often each is taken. Tasks combine ahead of the shuffle."""
    best = [live.groupBy(f"{s}_class").agg(F.min(F.struct(*_ORDER)).alias("_best")).select("_best.l_class", "_best.r_class") for s in "lr"]
    return live.join(best[0].join(best[1], ["l_class", "r_class"]), ["l_class", "r_class"]).select(
        "l_class", "r_class", "l_used", "r_used", F.least("l_free", "r_free").alias("many"), "amount_gap", "seconds_gap"
    )


def _left_over(live: DataFrame, taken: DataFrame) -> DataFrame:
    """The other pairs, of classes with rows left."""
    rest = live
    for s in "lr":
        spent = taken.select(f"{s}_class", F.col("many").alias("_many"))
        many = F.coalesce("_many", F.lit(0))
        rest = rest.join(spent, f"{s}_class", "left").withColumns({
            f"{s}_free": F.col(f"{s}_free") - many, f"{s}_used": F.col(f"{s}_used") + many,
        }).drop("_many")
    return rest.filter("l_free > 0 and r_free > 0").select(*live.columns)
