"""Versions, neighbours and joins as of a time, on plain keys and on keys cut in slices."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from subledger.operators import as_of_join, carry_forward, find_hot_keys, neighbour, valid_at, versions, with_late_changes

START = dt.datetime(2024, 1, 1)
#: Rows a task may take: none is hot, or those with most rows are.
SPLIT = [10_000, 40]


def at(n):
    return None if n is None else START + dt.timedelta(hours=n)


def changes(seed, many=400):
    """Two fifths of all rows belong to one key; nulls, repeated times and repeated rows are among them."""
    rng = random.Random(seed)
    rows = []
    for _ in range(many):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        rows.append((key, at(rng.choice([None, *range(60)])), rng.choice(["x", "y", None]), rng.randrange(2)))
    return rows + rows[:20]


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, at timestamp_ntz, name string, size int").repartition(3)


def digest(row):
    import hashlib

    return hashlib.md5("\x1f".join("\x1e" if v is None else str(v) for v in row[2:]).encode()).hexdigest()


def slow_versions(rows):
    out = []
    for key in {r[0] for r in rows if r[0] is not None}:
        points = {}
        for r in rows:
            if r[0] == key and r[1] is not None and (r[1] not in points or digest(r) > digest(points[r[1]])):
                points[r[1]] = r
        kept = []
        for when in sorted(points):
            if not kept or points[when][2:] != kept[-1][2:]:
                kept.append(points[when])
        out += [(k, n, s, w, kept[i + 1][1] if i + 1 < len(kept) else None) for i, (k, w, n, s) in enumerate(kept)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("rows_per_task", SPLIT)
def test_versions(spark, rows_per_task):
    rows = changes(1)
    found = versions(frame(spark, rows), "key", "at", ["name", "size"], rows_per_task)
    assert rows_of(found) == slow_versions(rows)


@pytest.mark.parametrize("rows_per_task", SPLIT)
def test_late_changes_split_intervals(spark, rows_per_task):
    rows = changes(2)
    on_time, late = frame(spark, rows[50:]), frame(spark, [r for r in rows[:50] if r[0] != "c"])
    history = versions(on_time, "key", "at", ["name", "size"], rows_per_task)
    found = with_late_changes(history, on_time, late, "key", "at", ["name", "size"], rows_per_task)
    assert rows_of(found) == slow_versions(rows[50:] + [r for r in rows[:50] if r[0] != "c"])


def test_an_observation_that_changed_nothing_may_end_an_interval_later(spark):
    observed, late = [("k", at(1), "x", 0), ("k", at(3), "x", 0)], [("k", at(2), "y", 0)]
    on_time = frame(spark, observed)
    history = versions(on_time, "key", "at", ["name", "size"], 10)
    assert rows_of(history) == [("k", "x", 0, at(1), None)]
    found = with_late_changes(history, on_time, frame(spark, late), "key", "at", ["name", "size"], 10)
    assert rows_of(found) == [("k", "x", 0, at(1), at(2)), ("k", "x", 0, at(3), None), ("k", "y", 0, at(2), at(3))]


def test_the_row_of_an_instant(spark):
    rows = changes(3)
    history = versions(frame(spark, rows), "key", "at", ["name", "size"], 40)
    slow = slow_versions(rows)
    for hour in (-1, 0, 7, 59, 1000):
        want = sorted((r for r in slow if r[3] <= at(hour) and (r[4] is None or r[4] > at(hour))), key=str)
        assert rows_of(valid_at(history, F.lit(at(hour)).cast("timestamp_ntz"))) == want


@pytest.mark.parametrize("rows_per_task", SPLIT)
@pytest.mark.parametrize("strictly", [False, True])
def test_join_as_of_a_time(spark, rows_per_task, strictly):
    rows, rng = changes(4), random.Random(5)
    events = [(n, rng.choice(["hot", "hot", "a", "b", "unknown", None]), at(rng.choice([None, *range(-3, 65)]))) for n in range(300)]
    found = as_of_join(
        spark.createDataFrame(events, "id int, key string, seen timestamp_ntz"), frame(spark, rows), "key", "seen", "at", ["name", "size"],
        rows_per_task, strictly_before=strictly,
    )
    want = []
    for event in events:
        before = [r for r in rows if event[1] and event[2] and r[0] == event[1] and r[1] and (r[1] < event[2] or not strictly and r[1] == event[2])]
        want.append((*event, *(max(before, key=lambda r: (r[1], digest(r)))[2:] if before else (None, None))))
    assert rows_of(found) == sorted(want, key=str)


def test_no_column_on_both_sides(spark):
    df = frame(spark, changes(6, 5))
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(df, df, "key", "at", "at", ["name"], 100)


def test_empty_tables(spark):
    none, some = frame(spark, []), frame(spark, changes(7, 30))
    assert versions(none, "key", "at", ["name"], 10).collect() == []
    assert rows_of(with_late_changes(versions(some, "key", "at", ["name"], 10), some, none, "key", "at", ["name"], 10)) == rows_of(versions(some, "key", "at", ["name"], 10))
    events = some.select("key", F.col("at").alias("seen"))
    assert as_of_join(events, none, "key", "seen", "at", ["name"], 10).filter("name is not null").count() == 0
    assert as_of_join(events.limit(0), some, "key", "seen", "at", ["name"], 10).collect() == []


def test_slices_of_a_hot_key_are_worked_on_apart(spark):
    """A hot key's rows lie in several slices; carried values and neighbours cross them."""
    df = spark.range(1000).selectExpr("'k' as key", "id as at", "if(id % 170 = 3, id, null) as value")
    hot = find_hot_keys(df.select("key"), "key", 100)
    assert hot.pieces >= 10
    filled = {r["at"]: r["value"] for r in carry_forward(df, ["at"], "value", hot).collect()}
    assert filled == {n: None if n < 3 else (n - 3) // 170 * 170 + 3 for n in range(1000)}
    for step in (-1, 1):
        beside = {r["at"]: r["other"] for r in neighbour(df, ["at"], "at", "other", hot, step).collect()}
        assert beside == {n: n + step if 0 <= n + step < 1000 else None for n in range(1000)}
