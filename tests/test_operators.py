from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from subledger.operators import (
    HotKeys, date_spine, day_spine, find_hot_keys, keep_first, left_join_few, left_join_many, month_spine, number_rows, row_digest,
)


def table(df):
    return sorted(map(tuple, df.collect()), key=repr)


def hot_set(hot):
    return {r.key for r in hot.keys.collect()} if hot else set()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_takes_the_same_row_however_the_input_is_laid_out(rows):
    df = rows("id int, v string", (1, "b"), (1, "a"), (1, None), (2, None), (None, "x"), (None, "w"))
    digests = {(r.id, r.v): r.d for r in df.select("*", row_digest(df, ["id"]).alias("d")).collect()}
    expected = [min((row for row in digests if row[0] == id), key=digests.get) for id in (1, 2, None)]
    for layout in (df, df.repartition(7), df.orderBy(F.desc("v")).coalesce(1)):
        assert table(keep_first(layout, ["id"], skip=["id"])) == sorted(expected, key=repr)


def test_digests_tell_rows_apart(rows):
    df = rows("a string, b string, x double, n int", ("1", "2", 1.0, 1), ("12", "", 1.0, 1), ("1", None, 1.0, 1), (None, "1", 1.0, 1),
              ("1", "2", 1.01, 1), ("1", "2", 1.0, None), ("1", "2", float("nan"), 1))
    assert df.select(row_digest(df).alias("d")).distinct().count() == 7
    assert df.select(row_digest(df, skip=["b", "x", "n"]).alias("d")).distinct().count() == 3


def test_keep_first_limits_groups_before_the_shuffle(rows):
    df = rows("id int, v string", (1, "a"))
    text = plan(keep_first(df, ["id"], [F.col("v")]))
    below_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below_shuffle


def test_hot_keys_are_found_null_included(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") < 3000, 7).when(F.col("id") < 6000, None).otherwise(F.col("id")).cast("bigint").alias("k")
    )
    hot = find_hot_keys(df, "k", 1000)
    assert hot_set(hot) == {7, None} and hot.pieces in (6, 7)
    assert not find_hot_keys(df, "k", 5000) and not find_hot_keys(df, "k", 9000)
    assert hot.marked(df).filter("_salts is not null").count() == 6000
    text = df.select((F.col("k").cast("string")).alias("k"))
    assert hot_set(find_hot_keys(text, "k", 1000)) == {"7", None}


def test_every_hot_key_has_the_salts_it_needs(spark):
    """A null key of very many rows beside a hot one: neither takes on the other's salts, and null is never repeated."""
    df = spark.range(21_000).select(F.when(F.col("id") < 1_000, 7).cast("bigint").alias("k"))
    hot = find_hot_keys(df, "k", 999)
    assert {r.key: r.salts for r in hot.keys.collect()} == {7: 8, None: 84}
    one_each = spark.createDataFrame([(7,), (None,), (3,)], "k bigint")
    assert {r.k: r["count"] for r in hot.repeated(one_each).groupBy("k").count().collect()} == {7: 8, None: 1, 3: 1}


def test_the_search_shuffles_no_row_per_record(spark):
    df = spark.range(20_000, numPartitions=8).select((F.col("id") % 15_000).alias("k"))
    sketch = df.agg(F.expr("approx_top_k(k, 10, 1024)"))
    text = sketch._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and "partial_approx_top_k" in text
    assert not find_hot_keys(df, "k", 1000)


def test_rows_of_hot_keys_are_numbered_as_a_window_would(spark):
    rng = random.Random(5)
    data = [
        (i, rng.choice([1, 1, 1, None, None, rng.randrange(2, 40)]),
         rng.choice([None, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(500))]))
        for i in range(4000)
    ]
    df = spark.createDataFrame(data, "id int, k int, t timestamp_ntz")
    order = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
    expected = df.withColumn("n", F.row_number().over(order).cast("bigint"))
    hot = find_hot_keys(df, "k", 300)
    assert {None, 1} <= hot_set(hot) and hot.pieces > 4
    got = number_rows(df, ["t", "id"], "n", hot)
    assert table(got) == table(expected) and got.schema == expected.schema
    assert table(number_rows(df, ["t", "id"], "n", HotKeys("k"))) == table(expected)


def test_no_task_numbers_a_whole_hot_key(spark):
    df = spark.range(8000).select(F.lit(1).alias("k"), "id")
    hot = find_hot_keys(df, "k", 1000)
    sizes = (
        df.repartitionByRange(hot.pieces, F.col("k").asc_nulls_last(), F.col("id").asc_nulls_last())
        .groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    )
    assert sizes <= 2000


@pytest.mark.parametrize("rows_per_task", [50, 10**6])
def test_salted_left_join_equals_the_plain_one(spark, rows_per_task):
    rng = random.Random(9)
    left = spark.createDataFrame([(k, f"l{k}") for k in [None, *range(30)]], "k int, l string")
    right = spark.createDataFrame(
        [(rng.choice([3, 3, 3, 8, 8, None, None, rng.randrange(20, 60)]), rng.choice(["same", f"r{i}"]), i % 3) for i in range(2000)],
        "k int, r string, x int",
    ).repartition(5)
    hot = find_hot_keys(right, "k", rows_per_task)
    assert bool(hot) == (rows_per_task == 50)
    got = left_join_many(left, right, hot, spread=["r"])
    assert table(got.select("k", "l", "r", "x")) == table(left.join(right, "k", "left").select("k", "l", "r", "x"))


@pytest.mark.parametrize("rows_per_task", [50, 10**6])
def test_spread_left_join_equals_the_plain_one(spark, rows_per_task):
    rng = random.Random(4)
    left = spark.createDataFrame([(rng.choice([3, 3, 8, None, None, rng.randrange(20, 60)]), i) for i in range(2000)], "k int, l int")
    right = spark.createDataFrame([(k, f"r{k}") for k in [None, 3, 3, *range(20, 40)]], "k int, r string")
    hot = find_hot_keys(left, "k", rows_per_task)
    assert bool(hot) == (rows_per_task == 50)
    got = left_join_few(left, right, hot, spread=["l"])
    assert table(got.select("k", "l", "r")) == table(left.join(right, "k", "left").select("k", "l", "r"))


def test_spines(spark):
    days = date_spine(spark, dt.date(2023, 12, 1), dt.date(2026, 6, 30))
    assert days.count() == 942
    assert days.agg(F.max("date_day")).first()[0] == dt.date(2026, 6, 29)
    assert date_spine(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 1)).count() == 0
    months = month_spine(spark, dt.date(2024, 1, 1), dt.date(2025, 12, 1))
    assert months.count() == 24 and month_spine(spark, dt.date(2024, 2, 1), dt.date(2024, 1, 1)).count() == 0


def test_calendar_of_no_data_is_empty(rows):
    assert day_spine(rows("start date, end date", (None, None))).count() == 0
