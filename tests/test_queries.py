"""Registered queries against their SQL counterparts, and the shape of their plans."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as entry_point
from raw import source
from subledger import Project
from subledger.plans import intermediate
from subledger.registry import REGISTRY, RETAIL
from subledger.sources import ParquetSource, RetailSource

FOLDER = "/root/testdata/sf0.001"
INPUTS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in INPUTS:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_a_counterpart():
    assert set(REGISTRY) <= set(entry_point.queries())
    assert set(REGISTRY) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name, keys", [
    ("cohort_retention", ["cohort_month", "months_since_first_order"]),
    ("revenue_reconciliation", ["order_month"]),
    ("subscription_health", ["report_month"]),
])
def test_reports_are_in_order(spark, duck, name, keys):
    """Row by row in the published order, not as sets; undated months come first or last alike."""
    df = entry_point.queries()[name](spark, FOLDER)
    columns = df.columns
    rows = duck.execute(f"select {', '.join(columns)} from ({entry_point.oracle_sql()[name]}) order by {', '.join(k + ' nulls first' for k in keys)}")
    assert [tuple(r) for r in df.collect()] == rows.fetchall()


def test_a_report_leaves_nothing_behind(spark):
    from pathlib import Path

    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    entry_point.queries()["dq_report"](spark, FOLDER).collect()
    assert {p.name for p in folder.iterdir()} == before


@pytest.mark.parametrize("name, used", [
    ("utm_parse", {"id", "created_at", "landing_site"}),
    ("first_touch", {"id", "customer_id", "created_at", "financial_status", "landing_site"}),
    ("dim_products", {"id", "product_id", "title", "variant_title", "sku", "price"}),
])
def test_copies_are_dropped_with_few_columns_in_the_shuffle(spark, settings, tmp_path, name, used):
    """From real raw tables, whose every column the digest covers: only the columns in use and the digest travel."""
    for table, df in source(spark).frames.items():
        df.write.parquet(str(tmp_path / table))
    text = joins_without_broadcast(spark, lambda: REGISTRY[name](Project(ParquetSource(spark, str(tmp_path)), settings)))
    lines = text.splitlines()
    at = max(n for n, line in enumerate(lines) if "Exchange hashpartitioning(id#" in line)
    below = next(line for line in lines[at + 1 :] if "WindowGroupLimit" in line or "Project [" in line or "Sort [" in line)
    project_line = next(line for line in lines[at:] if "Project [" in line)
    sent = set(re.findall(r"(\w+)#\d+L?", project_line.split("Project [", 1)[1].split("md5(")[0]))
    assert below and sent - {"_digest"} <= used, sent


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_its_counterpart(spark, duck, name):
    df = entry_point.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted((tuple(row) for row in cursor.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == expected
    assert expected, "an empty result proves nothing"


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in REGISTRY if n != "dq_report" and not n.startswith(("incremental_", "rebuilt_"))])
def test_no_pairing_and_no_python_in_any_plan(spark, name):
    df = REGISTRY[name](Project(RetailSource(spark, FOLDER), RETAIL))
    text = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert node not in text


def joins_without_broadcast(spark, df_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df_of()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_orders_are_shuffled_once_for_dedup_and_the_join_on_their_id(spark):
    text = joins_without_broadcast(spark, lambda: Project(RetailSource(spark, FOLDER), RETAIL).int_payments__reconciled)
    # orders by id, refunds by order, charges by order
    assert text.count("Exchange hashpartitioning") == 3


def test_order_facts_read_the_raw_orders_once(spark):
    text = joins_without_broadcast(spark, lambda: Project(RetailSource(spark, FOLDER), RETAIL).fct_orders)
    assert text.count("orders.parquet") == 1
    # retries, items twice (dedup, per order), orders and customers by customer, customers by e-mail, and their nation
    assert text.count("Exchange hashpartitioning") == 8


def test_the_report_drops_copies_once_for_all_tables(spark):
    text = joins_without_broadcast(spark, lambda: REGISTRY["dq_report"](Project(RetailSource(spark, FOLDER), RETAIL)))
    # items: raw checks, copies; orders too, and the raw tables that are made of them
    assert text.count("lineitem.parquet") == 2
    assert text.count("explode(CASE WHEN ((o_orderkey") == 2


def test_scans_read_only_needed_columns_and_take_the_filters(spark, settings, tmp_path):
    for table, df in source(spark).frames.items():
        df.write.parquet(str(tmp_path / table))
    p = Project(ParquetSource(spark, str(tmp_path)), settings)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    text = plan(p.fct_charges.groupBy("charge_month").count())
    assert "ReadSchema: struct<created_at:string>" in text
    text = plan(intermediate.refunds_per_order(p.stg_stripe__refunds))
    assert "PushedFilters: [IsNotNull(metadata_shopify_order_id)]" in text
    assert "ReadSchema: struct<amount:bigint,metadata_shopify_order_id:bigint>" in text
    text = plan(intermediate.successful_payments(p.stg_stripe__charges))
    assert "EqualTo(status,succeeded)" in text and "IsNotNull(metadata_shopify_order_id)" in text
