"""One-to-one matching and components against plain loops."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subledger.operators.components import connected_components
from subledger.operators.matching import Side, match_one_to_one

START = dt.datetime(2024, 1, 1)


def rows(seed, many, hot):
    """Few amounts and times, so that many rows differ in their id only; a share ``hot`` of them under one key."""
    rng = random.Random(seed)
    out = []
    for n in range(many):
        key = "hot" if rng.random() < hot else rng.choice(["a", "b", None])
        out.append((n + 1000 * seed, key, rng.choice([START + dt.timedelta(hours=rng.randrange(12)), None if rng.random() < 0.1 else START]), rng.choice([Decimal(rng.randrange(900, 912)) / 100, Decimal("9.50")])))
    return out


def greedy(left, right, amount, seconds):
    pairs = []
    for i, k, t, a in left:
        for j, l, u, b in right:
            if k and k == l and t and u and abs(a - b) <= amount and abs((t - u).total_seconds()) <= seconds:
                pairs.append((abs(a - b), int(abs((t - u).total_seconds())), t, a, u, b, i, j))
    used_left, used_right, out = set(), set(), []
    for gap, apart, _, _, _, _, i, j in sorted(pairs):
        if i not in used_left and j not in used_right:
            used_left.add(i)
            used_right.add(j)
            out.append((i, j, gap, apart))
    return sorted(out)


def matched(spark, left, right, amount, seconds, rows_per_task=10_000):
    schema = "id long, key string, at timestamp_ntz, amount decimal(10,2)"
    sides = [Side(spark.createDataFrame(r, schema).repartition(3), "id", "key", "at", "amount") for r in (left, right)]
    return sorted(map(tuple, match_one_to_one(*sides, F.lit(amount), seconds, rows_per_task).collect()))


@pytest.mark.parametrize("seed, rows_per_task", [(1, 10_000), (2, 30)])
def test_pairs_are_the_greedy_ones(spark, seed, rows_per_task):
    left, right = rows(2 * seed, 150, 0.6), rows(2 * seed + 1, 120, 0.6)
    assert matched(spark, left, right, Decimal("0.05"), 4 * 3600, rows_per_task) == greedy(left, right, Decimal("0.05"), 4 * 3600)


def test_pairs_that_wait_for_one_another(spark):
    """Each right row is nearest to the left row after it: only one pair is mutual best at a time."""
    left = [(n, "k", START, Decimal(n * (n + 1)) / 2 + 100) for n in range(1, 7)]
    right = [(100 + n, "k", START, Decimal(n * (n + 1)) / 2 + 100 + Decimal(n) * 0 + Decimal("0.4")) for n in range(1, 7)]
    assert matched(spark, left, right, Decimal("10"), 0) == greedy(left, right, Decimal("10"), 0)


def test_equal_rows_make_no_pairs_of_rows(spark):
    """20,000 x 15,000 rows that differ in their id only are one pair of classes."""
    left = spark.range(20_000).selectExpr("id", "'k' as key", "timestamp_ntz'2024-01-01 00:00:00' as at", "cast(1 as decimal(10,2)) as amount")
    right = left.filter("id < 15000").withColumn("id", F.col("id") + 100_000)
    found = match_one_to_one(Side(left, "id", "key", "at", "amount"), Side(right, "id", "key", "at", "amount"), F.lit(Decimal("1.00")), 60, 3000)
    assert found.agg(F.count("*"), F.countDistinct("left_id"), F.countDistinct("right_id"), F.max(F.col("right_id") - F.col("left_id"))).first() == (15_000, 15_000, 15_000, 100_000)


def test_no_rows(spark):
    some = rows(3, 10, 0.5)
    assert matched(spark, [], some, Decimal(1), 60) == matched(spark, some, [], Decimal(1), 60) == []
    assert matched(spark, [(1, None, START, Decimal(1))], [(2, None, START, Decimal(1))], Decimal(1), 60) == []


def components(edges):
    parent = {}

    def find(n):
        while parent.setdefault(n, n) != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in parent}


def test_components(spark):
    """Paths, a star that holds most edges, cycles, single loops, repeated edges and ends that are null."""
    rng = random.Random(4)
    shuffled = rng.sample(range(1000, 1060), 60)
    edges = list(zip(shuffled, shuffled[1:])) + [(5000, n) for n in range(2000, 2300)] + [(1, 2), (2, 3), (3, 1), (9, 9), (1, 2)]
    edges += [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, (7777, None), (None, 7)], "a int, b int").repartition(3)
    assert {r["node"]: r["component"] for r in connected_components(df, "a", "b").collect()} == components(edges)
    assert connected_components(df.limit(0), "a", "b").collect() == []
