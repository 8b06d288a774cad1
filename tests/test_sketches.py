"""Sketches that are rolled up, and differences between builds, against exact figures."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from subledger.operators.difference import differing_leaves, digest_tree, row_changes
from subledger.plans import sketches


def lines(spark, many, customers):
    """Half of all lines are of one channel and product; some channels and months are null."""
    return spark.range(many).selectExpr(
        "case when id % 2 = 0 then 'big' when id % 7 = 3 then null else concat('c', id % 5) end as channel",
        "case when id % 11 = 5 then null else add_months(date'2024-01-01', cast(id % 4 as int)) end as order_month",
        "concat('p', if(id % 2 = 0, 0, id % 3)) as product_id", f"id * 7919 % {customers} as shopify_customer_id",
        "cast(pow(id % 1000, 2) / 100 as decimal(12,2)) as value",
    )


@pytest.mark.parametrize("many, customers", [(500, 90), (60_000, 20_000)])
def test_merged_cells_keep_their_bounds(spark, many, customers):
    """Below the entries of a sketch counts are exact; beyond them they are estimates."""
    df = lines(spark, many, customers)
    for by in (["channel"], ["channel", "order_month"]):
        found = {tuple(r)[: len(by)]: tuple(r)[len(by) :] for r in sketches.checked_rollup(df, by).collect()}
        exact = df.groupBy(*by).agg(F.count("*"), F.countDistinct("shopify_customer_id")).collect()
        assert found == {tuple(r)[: len(by)]: (r[-2], r[-1], True, True) for r in exact}


def test_merging_is_the_sketch_of_all(spark):
    df = lines(spark, 3000, 900)
    merged = sketches.rolled_up(sketches.rolled_up(sketches.cells(df), ["channel", "order_month"]), ["channel"])
    assert {r.channel: r.customers_estimate for r in sketches.figures(merged).collect()} == {
        r.channel: r.n for r in df.groupBy("channel").agg(F.countDistinct("shopify_customer_id").alias("n")).collect()
    }


def test_retention_as_an_intersection(spark):
    rows = [(c, f"2024-0{1 + c % 3}-01", f"2024-0{m}-01") for c in range(300) for m in range(1, 7) if m >= 1 + c % 3 and (m == 1 + c % 3 or (c * m) % 4 == 0)]
    months = spark.createDataFrame(rows, "customer_id int, a string, o string").selectExpr("customer_id", "date(a) as acquisition_cohort_month", "date(o) as order_month")
    found = sketches.checked_retention(months).collect()
    assert len(found) > 10 and all(r.within_bound for r in found) and sum(r.customers_active for r in found) == len(rows)


def test_no_lines(spark):
    none = lines(spark, 5, 5).limit(0)
    assert sketches.checked_rollup(none, ["channel"]).collect() == []
    empty = spark.createDataFrame([], "customer_id int, acquisition_cohort_month date, order_month date")
    assert sketches.checked_retention(empty).collect() == []


def slow_changes(before, after):
    """(key, change, column, before, after, copies), from the rows as lists."""
    names, out = ["part", "x", "y"], []
    for key in {r[0] for r in before} | {r[0] for r in after}:
        old, new = [r for r in before if r[0] == key], [r for r in after if r[0] == key]
        for r in list(old):
            if r in new:
                old.remove(r)
                new.remove(r)
        if len(old) == len(new) == 1:
            out += [(key, "changed", n, *(None if v is None else str(v) for v in pair), 1) for n, *pair in zip(names, old[0][1:], new[0][1:]) if pair[0] != pair[1]]
        else:
            out += [(key, kind, None, None, None, len(side)) for kind, side in (("removed", old), ("added", new)) if side]
    return sorted(out, key=str)


def test_differences(spark, tmp_path):
    """Changes in some months only, rows that move to another month, repeated rows, a key with a third of all rows, nulls."""
    rng = random.Random(1)
    before = [(rng.choice([7, rng.randrange(150), None]), rng.choice(["m1", "m2", "m3", "m4", None]), rng.choice([1, 2, None]), "y") for _ in range(300)]
    after = list(before)
    for n in rng.sample(range(300), 40):
        if after[n][1] in ("m2", None):
            after[n] = (after[n][0], rng.choice(["m2", "m3"]), rng.choice([1, 5]), "z")
    after += [(999, "m2", 1, "new"), (999, "m2", 1, "new"), before[0] if before[0][1] == "m2" else (1000, "m2", None, None)]
    schema, builds = "k int, part string, x int, y string", []
    for name, rows in (("before", before), ("after", after)):
        spark.createDataFrame(rows, schema).write.partitionBy("part").parquet(str(tmp_path / name))
        builds.append(spark.read.schema(schema).parquet(str(tmp_path / name)).select("k", "part", "x", "y"))
    trees = tuple(digest_tree(b, ["k"], "part", 8) for b in builds)
    found = row_changes(*builds, trees, ["k"], "part", 8)
    # Rows of months without a difference cancel out wherever they are compared, so the slow way may read all.
    changed = {r["part"] for r in differing_leaves(*trees).collect()}
    assert {"m2"} <= changed <= {"m2", "m3", None}
    kept = lambda rows: [r for r in rows if r[1] in changed]
    assert sorted(map(tuple, found.collect()), key=str) == slow_changes(kept(before), kept(after))
    files = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in files.replace("PartitionFilters: [(part", "PartitionFilters: [part") or "part#" in files
    same = row_changes(builds[0], builds[0], (trees[0], trees[0]), ["k"], "part", 8)
    assert same.collect() == []


def test_differences_of_empty_builds(spark):
    none, some = (spark.createDataFrame(rows, "k int, part string, x int") for rows in ([], [(1, "m", 2)]))
    tree = lambda df: digest_tree(df, ["k"], "part", 4)
    assert row_changes(none, none, (tree(none), tree(none)), ["k"], "part", 4).collect() == []
    assert [tuple(r) for r in row_changes(none, some, (tree(none), tree(some)), ["k"], "part", 4).collect()] == [(1, "added", None, None, None, 1)]
