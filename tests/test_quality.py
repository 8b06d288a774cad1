from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal as D

from pyspark.sql import functions as F

from raw import source
from subledger import Project
from subledger.plans import quality


def test_duplicated(rows):
    df = rows("x int", (1,), (1,), (2,), (None,), (None,))
    assert [tuple(r) for r in quality.duplicated(df, "x").collect()] == [(1, 2)]


def test_missing_and_outside(rows):
    df = rows("x string", ("a",), ("b",), (None,))
    assert quality.missing(df, "x").count() == 1
    assert [r.x for r in quality.outside(df, "x", ["a"]).collect()] == ["b"]
    assert quality.outside(df, "x", ["a", "b"]).count() == 0


def test_orphans(rows):
    child, parent = rows("k int", (1,), (2,), (2,), (None,)), rows("id int", (1,), (1,), (None,))
    assert [r.k for r in quality.orphans(child, "k", parent, "id").collect()] == [2, 2]


def test_failing_lets_the_unknown_pass(rows):
    assert [r.x for r in quality.failing(rows("x int", (1,), (-1,), (None,)), F.col("x") >= 0).collect()] == [-1]


def test_stale(rows, settings):
    df = rows("t timestamp_ntz", (dt.datetime(2025, 6, 26, 12),), (dt.datetime(2025, 6, 1),))
    assert quality.stale(df, "t", 3, settings).first().most_recent == dt.datetime(2025, 6, 26, 12)
    assert quality.stale(df, "t", 4, settings).count() == 0
    assert quality.stale(df.limit(0), "t", 4, settings).count() == 0


def test_disagreeing_months(rows, settings):
    df = rows(
        "order_month date, shopify_revenue decimal(20,2), stripe_net_settled decimal(20,2)",
        (dt.date(2024, 1, 1), D("100.00"), D("95.00")), (dt.date(2024, 2, 1), D("100.00"), D("95.01")),
        (dt.date(2024, 3, 1), D("0.00"), D("5.00")),
    )
    assert [r.order_month.month for r in quality.disagreeing_months(df, settings).collect()] == [1]


def test_every_declared_check_is_there_once():
    checks = list(quality.declared_checks())
    assert Counter(c.kind for c in checks) == {"unique": 28, "not_null": 41, "accepted_values": 8, "expression": 5}
    assert len({(c.table, c.column, c.kind) for c in checks}) == 82


def test_report_counts_the_seeded_defects(spark, settings):
    p = Project(source(
        spark,
        raw_shopify__orders=[
            {"id": 1, "customer_id": 1, "created_at": "2024-01-01T00:00:00-05:00", "financial_status": "paid", "total_price": 5.0},
            {"id": 1, "customer_id": 1, "created_at": "2024-01-01T00:00:01-05:00", "financial_status": "paid", "total_price": 5.0},
            {"id": 2, "customer_id": None, "created_at": "2024-01-01T00:00:00-05:00", "financial_status": "odd", "total_price": 5.0},
        ],
        raw_stripe__charges=[
            {"id": i, "metadata_shopify_order_id": 1, "amount": a, "amount_refunded": 0, "status": "succeeded"}
            for i, a in (("a", 500), ("b", -500))
        ],
        raw_shopify__order_line_items=[
            {"id": 1, "order_id": 1, "sku": "S", "price": 1.0, "quantity": 1}, {"id": 2, "order_id": 1, "sku": "S", "price": 2.0, "quantity": 1},
        ],
    ), settings)
    got = {(r.table_name, r.column_name, r.check_name): r.violations for r in quality.report(p.table).collect()}
    assert len(got) == 82
    assert {k: v for k, v in got.items() if v} == {
        ("raw_shopify__orders", "customer_id", "not_null"): 1,
        ("raw_shopify__orders", "financial_status", "accepted_values"): 1,
        ("stg_shopify__orders", "shopify_customer_id", "not_null"): 1,
        ("stg_shopify__orders", "financial_status", "accepted_values"): 1,
        ("int_payments__reconciled", "order_id", "unique"): 1,
        ("fct_orders", "customer_id", "not_null"): 1,
        ("dim_products", "sku", "unique"): 1,
        ("stg_stripe__charges", "charge_amount", "expression"): 1,
    }
