from __future__ import annotations

import csv

import pytest

from raw import SYSTEM, source
from subledger import Project
from subledger.plans.project import CORE, REPORTING
from subledger.plans.warehouse import CatalogSink, ParquetSink, VersionedSink, build, load_raw, published
from subledger.registry import RETAIL
from subledger.session import materialized, shared_folder
from subledger.sources import RAW_TABLES, CatalogSource, CsvSource, ParquetSource, RetailSource, raw_schema

RETAIL_FOLDER = "/root/testdata/sf0.001"


def write_csv(folder, table, *records):
    names = raw_schema(SYSTEM[table], table).names
    with open(folder / f"{table}.csv", "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(names)
        writer.writerows([[r.get(n, "") for n in names] for r in records])


def test_csv_blanks_are_null_and_types_are_declared(spark, tmp_path):
    write_csv(tmp_path, "raw_stripe__refunds", {"id": "re_1", "amount": 500, "reason": ""}, {"id": "re_2", "reason": 'say "x", y'})
    df = CsvSource(spark, str(tmp_path)).read("stripe", "raw_stripe__refunds")
    assert df.schema == raw_schema("stripe", "raw_stripe__refunds")
    first, second = df.orderBy("id").collect()
    assert (first.amount, first.reason, first.metadata_shopify_order_id) == (500, None, None)
    assert second.reason == 'say "x", y'


def test_csv_with_bad_numbers_fails(spark, tmp_path):
    write_csv(tmp_path, "raw_stripe__refunds", {"id": "re_1", "amount": "many"})
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        CsvSource(spark, str(tmp_path)).read("stripe", "raw_stripe__refunds").collect()


def test_csv_files_become_typed_tables(spark, settings, tmp_path):
    (tmp_path / "csv").mkdir()
    for table in SYSTEM:
        write_csv(tmp_path / "csv", table, *([{"id": 1, "created_at": "2024-01-01T00:00:00-05:00", "total_price": "32.24"}]
                                             if table == "raw_shopify__orders" else []))
    load_raw(CsvSource(spark, str(tmp_path / "csv")), ParquetSink(spark, str(tmp_path / "tables")))
    p = Project(ParquetSource(spark, str(tmp_path / "tables" / "raw")), settings)
    assert str(p.stg_shopify__orders.first().gross_revenue) == "32.24"
    assert p.rpt_subscription_health.count() == 24 and p.fct_subscriptions.count() == 0


def test_parquet_and_catalog_sources(spark, tmp_path):
    frames = source(spark, raw_shopify__orders=[{"id": 1, "total_price": 2.5}]).frames
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_db")
    for table, df in frames.items():
        df.write.parquet(str(tmp_path / table))
        df.write.mode("overwrite").saveAsTable(f"raw_db.{table}")
    for src in (ParquetSource(spark, str(tmp_path)), CatalogSource(spark, "raw_db")):
        for system, tables in RAW_TABLES.items():
            for table in tables:
                assert src.read(system, table).dtypes == frames[table].dtypes
        assert src.read("shopify", "raw_shopify__orders").first().total_price == 2.5


def test_retail_source_has_every_column(spark):
    src = RetailSource(spark, RETAIL_FOLDER)
    for system, tables in RAW_TABLES.items():
        for table in tables:
            schema = raw_schema(system, table)
            assert [(f.name, f.dataType) for f in src.read(system, table).schema] == [(f.name, f.dataType) for f in schema]


@pytest.mark.parametrize("kind", ["parquet", "catalog"])
def test_written_tables_equal_the_planned_ones(spark, tmp_path, kind):
    planned = Project(RetailSource(spark, RETAIL_FOLDER), RETAIL)
    sink = ParquetSink(spark, str(tmp_path)) if kind == "parquet" else CatalogSink(spark)
    for _ in range(2):  # the second run replaces the first
        written = build(Project(RetailSource(spark, RETAIL_FOLDER), RETAIL), sink)
    for name in CORE + REPORTING:
        a, b = planned.table(name), written.table(name)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert spark.table("stg_recharge__charges").count() == planned.stg_recharge__charges.count()
    january = written.fct_orders.filter("order_month = DATE'1996-01-01'")
    assert "PartitionFilters: [isnotnull(order_month" in january._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialized(spark.range(5))
    assert df.count() == 5 and shared_folder(spark) in df.inputFiles()[0]


def test_readers_find_a_run_when_it_is_published(spark, tmp_path):
    runs = [VersionedSink(spark, str(tmp_path)) for _ in range(2)]
    for n, sink in enumerate(runs):
        sink.write(spark.range(n + 1), "marts", "t", None)
    runs[0].publish(1)
    assert published(spark, str(tmp_path)) == runs[0].root != runs[1].root
    runs[1].publish(2)
    assert spark.read.parquet(f"{published(spark, str(tmp_path))}/marts/t").count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        runs[0].publish(2)
    assert published(spark, str(tmp_path)) == runs[1].root


def test_the_shipped_shape_of_refunds(spark, settings):
    """Fifteen refunds name no order, one order has two: the first count for no order, the second are summed."""
    orders = [{"id": n, "customer_id": 1, "created_at": "2024-01-10T12:00:00-05:00", "financial_status": "refunded", "total_price": 50.0, "total_discounts": 0.0} for n in range(1, 4)]
    refunds = [{"id": f"re_orphan_{n}", "amount": 700, "status": "succeeded"} for n in range(15)]
    refunds += [{"id": f"re_{n}", "amount": 100 * n, "status": "succeeded", "metadata_shopify_order_id": 2} for n in (1, 2)]
    p = Project(source(spark, raw_shopify__orders=orders, raw_stripe__refunds=refunds), settings)
    found = {r.order_id: (float(r.stripe_refund_amount), r.stripe_refund_count) for r in p.int_payments__reconciled.collect()}
    assert found == {1: (0.0, 0), 2: (3.0, 2), 3: (0.0, 0)} and p.stg_stripe__refunds.count() == 17
