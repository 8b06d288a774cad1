from __future__ import annotations

import datetime as dt
import random
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from raw import source
from subledger import Project
from subledger.plans import core, reporting
from subledger.plans.warehouse import ParquetSink, build


def order(id, customer=1, day="2024-01-10", status="paid", site=None, total=10.0, time="12:00:00", **more):
    return {
        "id": id, "customer_id": customer, "created_at": f"{day}T{time}-05:00", "financial_status": status,
        "landing_site": site, "total_price": total, "total_discounts": 0.0, **more,
    }


def utm(source_name, medium=None):
    return f"/?utm_source={source_name}" + (f"&utm_medium={medium}" if medium is not None else "")


def project(spark, settings, **tables):
    return Project(source(spark, **tables), settings)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_sequence_skips_voided_orders_and_breaks_ties_by_id(spark, settings):
    p = project(spark, settings, raw_shopify__orders=[
        order(1, status=None), order(2, status="voided", day="2024-01-01"), order(3, day="2024-01-05"),
        order(5, day="2024-01-06"), order(4, day="2024-01-06"), order(6, customer=None), order(7, customer=None, day="2024-01-02"),
    ])
    got = {r.order_id: r.customer_order_sequence for r in p.int_orders__enriched.collect()}
    assert got == {3: 1, 4: 2, 5: 3, 7: 1, 6: 2}


def test_order_contents(spark, settings):
    item = {"price": 10.0, "quantity": 2, "total_discount": 1.0}
    p = project(
        spark, settings, raw_shopify__orders=[order(1), order(2), order(3)],
        raw_shopify__order_line_items=[
            {"id": 11, "order_id": 1, "title": "b", "sku": "S2", **item},
            {"id": 12, "order_id": 1, "title": "a", "sku": "S1", **item},
            {"id": 13, "order_id": 1, "title": "b", "sku": None, **item},
            {"id": 13, "order_id": 1, "title": "c", "sku": None, **item},
            {"id": 21, "order_id": 2, "title": None, "sku": None, **item},
        ],
    )
    got = by(p.int_orders__enriched, "order_id")
    assert (got[1].item_count, got[1].total_units, got[1].product_names, got[1].skus) == (3, 6, "a, b", "S1, S2")
    assert (got[2].product_names, got[2].skus) == ("", "")
    assert (got[3].item_count, got[3].total_units, got[3].product_names) == (0, 0, None)


def test_channel_labels(spark, settings):
    p = project(spark, settings, raw_shopify__orders=[
        order(1, site=utm("google", "cpc")), order(2, site=utm("email")), order(3, site=utm("", "cpc")), order(4, site="/"),
        order(5, site="/?utm_medium=cpc"),
    ])
    got = {r.order_id: r.channel for r in p.int_orders__enriched.collect()}
    assert got == {1: "google / cpc", 2: "email / (none)", 3: " / cpc", 4: None, 5: None}


def test_first_touch_passes_over_orders_without_a_channel(spark, settings):
    p = project(
        spark, settings, raw_shopify__customers=[{"id": 1, "email": "a"}, {"id": 2, "email": "b"}, {"id": 3, "email": "c"}],
        raw_shopify__orders=[
            order(1, day="2024-01-01", site="/"), order(2, day="2024-02-01", site=utm("a")), order(3, day="2024-03-01", site=utm("b")),
            order(4, customer=2, site="/"),
        ],
    )
    got = by(p.dim_customers, "customer_id")
    assert got[1].acquisition_channel == "a / (none)" and got[2].acquisition_channel is None
    assert (got[1].lifetime_orders, got[1].lifetime_revenue, got[1].avg_order_value) == (3, D("30.00"), D("10.000000"))
    assert got[1].acquisition_cohort_month == dt.date(2024, 1, 1)
    assert (got[3].lifetime_orders, got[3].lifetime_revenue, got[3].first_order_at) == (0, D("0.00"), None)
    assert got[1].days_since_last_order == (dt.date(2025, 6, 30) - dt.date(2024, 3, 1)).days
    assert p.dim_customers.count() == 3
    facts = by(p.fct_orders, "order_id")
    assert {r.acquisition_channel for k, r in facts.items() if k < 4} == {"a / (none)"}
    assert facts[1].is_first_order is True and facts[2].is_first_order is False


def test_customer_spine(spark, settings):
    p = project(
        spark, settings, raw_shopify__customers=[{"id": 1, "email": "A@x "}, {"id": 2, "email": "b@x"}, {"id": 3, "email": None}],
        raw_recharge__customers=[
            {"id": 91, "email": "a@X", "created_at": "2024-01-01T00:00:00Z", "status": "OLD"},
            {"id": 92, "email": "a@x", "created_at": "2024-02-01T00:00:00Z", "status": "NEW", "has_payment_method_in_dunning": "true"},
            {"id": 93, "email": None, "created_at": "2024-02-01T00:00:00Z"},
        ],
        raw_recharge__subscriptions=[
            {"id": 1, "shopify_customer_id": 1, "status": "active", "price": 10.0},
            {"id": 2, "shopify_customer_id": 1, "status": "active", "price": 30.0},
            {"id": 3, "shopify_customer_id": 1, "status": "cancelled", "price": 99.0},
            {"id": 4, "shopify_customer_id": 2, "status": "expired", "price": 5.0},
        ],
    )
    spine = by(p.int_customers__unified, "shopify_customer_id")
    assert (spine[1].recharge_customer_id, spine[1].recharge_status, spine[1].is_subscriber) == (92, "new", True)
    assert (spine[2].recharge_customer_id, spine[2].is_subscriber, spine[2].is_in_dunning) == (None, False, None)
    assert spine[3].recharge_customer_id is None
    dim = by(p.dim_customers, "customer_id")
    assert (dim[1].total_subscriptions, dim[1].active_subscriptions, dim[1].current_subscription_price) == (3, 2, D("30.00"))
    assert (dim[2].total_subscriptions, dim[2].active_subscriptions, dim[2].current_subscription_price) == (1, 0, None)
    assert (dim[1].customer_type, dim[2].customer_type) == ("subscriber", "one_time")


def paid(id, order_id, cents, status="succeeded"):
    return {"id": id, "metadata_shopify_order_id": order_id, "amount": cents, "amount_refunded": 0, "status": status}


@pytest.mark.parametrize("rows_per_task", [2_000_000, 1])
def test_reconciliation(spark, settings, rows_per_task):
    refund = lambda id, order_id, cents: {"id": id, "metadata_shopify_order_id": order_id, "amount": cents}
    p = project(
        spark, replace(settings, rows_per_task=rows_per_task),
        raw_shopify__orders=[
            order(1), order(2), order(3), order(4), order(5, status="refunded"), order(6, status=None), order(7, status="voided"),
            order(8), order(9, total=None),
        ],
        raw_stripe__charges=[
            paid("c2", 2, 1001), paid("c3", 3, 1002), paid("c4", 4, 1000), paid("c5", 5, 1000), paid("c6", 6, 1000),
            paid("c7", 7, 1000), paid("c8a", 8, 1000), paid("c8b", 8, 1000), paid("c8c", 8, 1000, "failed"),
            paid("c1", 1, 1000, "failed"), paid("ghost", None, 500, "failed"), paid("stray", None, 500), paid("c9", 9, 1000),
        ],
        raw_stripe__refunds=[refund("r4", 4, 100), refund("r4b", 4, 200), refund("r5", 5, 100), refund("r6", 6, 100), refund("x", None, 9)],
    )
    got = sorted(p.int_payments__reconciled.collect(), key=lambda r: (r.order_id, r.stripe_charge_id or ""))
    assert [(r.order_id, r.stripe_charge_id, r.reconciliation_status) for r in got] == [
        (1, None, "no_stripe_match"), (2, "c2", "reconciled"), (3, "c3", "amount_mismatch"), (4, "c4", "orphaned_refund"),
        (5, "c5", "reconciled"), (6, "c6", "reconciled"), (7, "c7", "reconciled"), (8, "c8a", "reconciled"),
        (8, "c8b", "reconciled"), (9, "c9", "reconciled"),
    ]
    fourth = got[3]
    assert (fourth.stripe_refund_amount, fourth.stripe_refund_count, fourth.stripe_net_settled) == (D("3.00"), 2, D("7.00"))
    assert (got[0].stripe_net_settled, got[0].revenue_variance) == (D("0.00"), None)
    assert got[2].revenue_variance == D("-0.02")


def subscription(id, status="active", created="2024-01-15T00:00:00Z", cancelled=None, price=30.0, days=30, customer=1):
    return {
        "id": id, "status": status, "created_at": created, "cancelled_at": cancelled, "price": price,
        "charge_interval_frequency": days, "shopify_customer_id": customer,
    }


def test_subscription_facts(spark, settings):
    charge = lambda id, sub, status, total=10.0: {"id": id, "subscription_id": sub, "status": status, "total_price": total}
    p = project(
        spark, settings,
        raw_recharge__subscriptions=[
            subscription(1, price=109.99, days=90), subscription(2, "cancelled", cancelled="2024-02-15T23:00:00Z", price=109.99, days=90),
            subscription(3, days=60, price=29.99),
        ],
        raw_recharge__charges=[charge(1, 1, "SUCCESS"), charge(2, 1, "ERROR"), charge(3, 1, "declined"), charge(4, 1, "QUEUED"), charge(5, 2, "REFUNDED")],
    )
    got = by(p.fct_subscriptions, "subscription_id")
    assert [got[i].monthly_recurring_revenue for i in (1, 2, 3)] == [D("36.66"), D("0.00"), D("15.00")]
    assert (got[1].total_charge_attempts, got[1].successful_charges, got[1].failed_charges) == (4, 1, 2)
    assert (got[1].total_charged_revenue, got[1].failure_rate) == (D("10.00"), D("0.5000"))
    assert (got[2].failure_rate, got[3].failure_rate, got[3].total_charge_attempts) == (D("0.0000"), None, 0)
    assert got[2].subscription_duration_days == 31
    assert got[1].subscription_duration_days == (dt.date(2025, 6, 30) - dt.date(2024, 1, 15)).days


def test_without_a_report_time_days_run_to_today(spark, settings):
    p = project(spark, replace(settings, as_of=None), raw_recharge__subscriptions=[subscription(1)])
    def days():
        return p.fct_subscriptions.first().subscription_duration_days

    before, zone = dt.datetime.now(dt.timezone.utc).date(), spark.conf.get("spark.sql.session.timeZone")
    try:
        found = set()
        for name in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found.add(days())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    possible = {(d - dt.date(2024, 1, 15)).days for d in (before, dt.datetime.now(dt.timezone.utc).date())}
    assert found <= possible


def test_zero_interval_fails_unless_told_otherwise(spark, settings):
    tables = {"raw_recharge__subscriptions": [subscription(1, days=0), subscription(2, status="expired", days=0)]}
    with pytest.raises(ArithmeticException):
        project(spark, settings, **tables).fct_subscriptions.collect()
    got = by(project(spark, replace(settings, zero_interval="null"), **tables).fct_subscriptions, "subscription_id")
    assert (got[1].monthly_recurring_revenue, got[2].monthly_recurring_revenue) == (None, D("0.00"))


def test_products(spark, settings):
    item = lambda id, variant, title="Serum", price=10.0, sku="S": {
        "id": id, "product_id": "P", "title": title, "variant_title": variant, "sku": sku, "price": price
    }
    p = project(spark, settings, raw_shopify__order_line_items=[
        item(1, "30-Day supply"), item(2, "30-Day supply"), item(3, "30-Day supply", price=12.0), item(4, "90-day", title="Big BUNDLE"),
        item(5, None, sku="T"),
    ])
    got = sorted((r.sku, str(r.current_price), r.supply_duration_days, r.supply_tier, r.product_type) for r in p.dim_products.collect())
    assert got == sorted([
        ("S", "10.00", 30, "30-day", "single"), ("S", "12.00", 30, "30-day", "single"), ("S", "10.00", 90, "90-day", "bundle"),
        ("T", "10.00", None, "other", "single"),
    ])


def test_dates(spark, settings):
    days = by(project(spark, settings).dim_dates, "date_key")
    assert len(days) == 942
    saturday = days[dt.date(2024, 7, 6)]
    assert (saturday.day_name, saturday.month_name, saturday.year_quarter, saturday.year_month) == ("Sat", "Jul", "2024-Q3", "2024-07")
    assert [days[dt.date(2024, 7, d)].is_weekend for d in (5, 6, 7, 8)] == [False, True, True, False]
    assert (saturday.month_start, saturday.month_end, saturday.quarter_number) == (dt.date(2024, 7, 1), dt.date(2024, 7, 31), 3)


def test_charge_facts(spark, settings):
    p = project(spark, settings, raw_recharge__charges=[{"id": 1, "created_at": "2024-03-31T23:59:00Z", "status": "success"}])
    got = p.fct_charges.first()
    assert (got.charge_date, got.charge_month) == (dt.date(2024, 3, 31), dt.date(2024, 3, 1))


def cohort_input():
    customers = [{"id": i, "email": str(i), "created_at": "2024-01-01T00:00:00-05:00"} for i in (1, 2, 3)]
    customers.append({"id": 4, "email": "3", "created_at": "2023-01-01T00:00:00-05:00"})  # loses its e-mail to customer 3
    orders = [
        order(1), order(2, day="2024-01-20"), order(3, day="2024-03-02"), order(4, customer=2, day="2024-01-02"),
        order(5, customer=3, day="2024-02-10"), order(6, customer=4, day="2024-01-10"), order(7, customer=None),
        order(8, customer=2, day="2025-01-02"),
    ]
    orders.append({**order(9, customer=1), "created_at": None})
    return {"raw_shopify__customers": customers, "raw_shopify__orders": orders}


def test_cohort_retention(spark, settings):
    p = project(spark, settings, **cohort_input())
    got = [tuple(r) for r in p.rpt_monthly_cohort_retention.collect()]
    january, february = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    assert got == [
        (january, None, 2, 1, 0.5), (january, 0, 2, 2, 1.0), (january, 2, 2, 1, 0.5), (january, 12, 2, 1, 0.5), (february, 0, 1, 1, 1.0),
    ]


def test_cohort_retention_is_the_same_from_the_order_facts(spark, settings):
    p = project(spark, settings, **cohort_input())
    months = p.fct_orders.select("customer_id", "acquisition_cohort_month", "order_month").distinct()
    assert reporting.cohort_retention(months).collect() == p.rpt_monthly_cohort_retention.collect()


def test_order_facts_in_one_pass_equal_the_join_with_the_dimension(spark, settings):
    tables = cohort_input()
    tables["raw_shopify__customers"].append({"id": 2, "email": "other"})  # an id with two records repeats its orders
    tables["raw_shopify__orders"] += [order(20 + i, customer=1 + i % 5, day=f"2024-05-0{1 + i % 3}", site=site)
                                      for i, site in enumerate(["/", utm("a"), None, utm("b", "c"), utm(""), "/"] * 3)]
    p = project(spark, settings, **tables)
    same(p.fct_orders, core.order_facts(p.int_orders__enriched, p.acquired, p.hot_customers))
    same(p.fct_orders, core.order_facts(p.int_orders__enriched, p.dim_customers, p.hot_customers))


def test_revenue_report(spark, settings):
    p = project(
        spark, settings, raw_shopify__orders=[order(1, total=100.0), order(2, total=100.0), order(3, day="2024-02-03", total=0.0)],
        raw_stripe__charges=[paid("a", 1, 9999)], raw_stripe__refunds=[{"id": "r", "amount": 1000, "metadata_shopify_order_id": 1}],
    )
    first, second = p.rpt_revenue_reconciliation.collect()
    assert (first.total_orders, first.shopify_revenue, first.stripe_gross_revenue) == (2, D("200.00"), D("99.99"))
    assert (first.stripe_total_refunds, first.stripe_net_settled) == (D("10.00"), D("89.99"))
    assert (first.gross_revenue_variance, first.variance_pct, first.exceeds_variance_threshold) == (D("100.01"), D("0.5001"), True)
    assert (first.orphaned_refunds, first.unmatched_orders, first.reconciliation_rate) == (1, 1, D("0.0000"))
    assert (second.variance_pct, second.exceeds_variance_threshold) == (None, False)


def literal_health(subscriptions, settings):
    """The definition taken at its word: every month beside every subscription."""
    first, last = reporting.report_months(settings)
    months, month = [], first
    while month <= last:
        months.append(month)
        month = (month + dt.timedelta(days=32)).replace(day=1)
    out = []
    for month in months:
        start = dt.datetime.combine(month, dt.time())
        nxt = dt.datetime.combine((month + dt.timedelta(days=32)).replace(day=1), dt.time())
        live = [s for s in subscriptions if s[1] and s[1] <= nxt and (s[2] is None or s[2] > start)]
        of_month = lambda t: t is not None and (t.year, t.month) == (month.year, month.month)
        ids = lambda rows: len({s[0] for s in rows if s[0] is not None})
        out.append((
            month, ids(live), ids(s for s in subscriptions if of_month(s[1])), ids(s for s in subscriptions if of_month(s[2])),
            sum((s[3] for s in live if s[3] is not None), D(0)),
        ))
    return out


def test_subscription_months_equal_the_literal_pairing(spark, settings):
    rng = random.Random(3)
    edges = [dt.datetime(y, m, 1) for y in (2023, 2024, 2025, 2026) for m in range(1, 13)]

    def when():
        base = rng.choice(edges)
        return rng.choice([base, base + dt.timedelta(days=rng.randrange(28), hours=3), base - dt.timedelta(microseconds=1)])

    rows = []
    for i in range(3000):
        key = rng.choice([i, i, i, rng.randrange(40), None])  # repeated ids with overlapping and separate lives
        rows.append((key, rng.choice([when()] * 9 + [None]), rng.choice([None, when()]), rng.choice([D("10.50"), D("0.00"), None])))
    rows += [(7, dt.datetime(2024, 2, 1), dt.datetime(2024, 4, 1), D("1.00"))] * 5
    subscriptions = spark.createDataFrame(
        rows, "subscription_id int, subscription_created_at_utc timestamp_ntz, subscription_cancelled_at_utc timestamp_ntz, "
        "monthly_recurring_revenue decimal(10,2)",
    )
    charges = spark.createDataFrame([], "charge_month date, is_successful_charge boolean, is_failed_charge boolean, charge_total decimal(10,2)")
    report = reporting.subscription_health(subscriptions, charges, settings).select(
        "report_month", "active_subscriptions", "new_subscriptions", "cancelled_subscriptions", "monthly_recurring_revenue"
    )
    assert [tuple(r) for r in report.collect()] == literal_health(rows, settings)


def test_month_edges_of_a_subscription(spark, settings):
    p = project(spark, settings, raw_recharge__subscriptions=[
        subscription(1, created="2024-02-01T00:00:00Z", cancelled="2024-04-01T00:00:00Z", status="cancelled")
    ])
    months = {r.report_month.month: r for r in p.rpt_subscription_health.filter(F.year("report_month") == 2024).collect()}
    assert [m for m, r in months.items() if r.active_subscriptions] == [1, 2, 3]
    assert months[2].new_subscriptions == 1 and months[4].cancelled_subscriptions == 1
    assert (months[4].churn_rate, months[5].net_subscription_change) == (None, 0)


def test_report_without_subscriptions_has_every_month(spark, settings):
    got = project(spark, settings).rpt_subscription_health.collect()
    assert len(got) == 24 and {r.active_subscriptions for r in got} == {0}


def same(a, b):
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ids_many_records_share(spark, settings):
    rng = random.Random(2)
    key = lambda: rng.choice([1, 1, None, rng.randrange(2, 20)])
    tables = {
        "raw_shopify__customers": [{"id": key(), "email": f"{i}@x"} for i in range(400)],
        "raw_shopify__orders": [order(i, customer=key()) for i in range(100)],
        "raw_recharge__subscriptions": [
            {**subscription(key(), customer=key(), created=f"2024-0{rng.randrange(1, 9)}-01T00:00:00Z"), "customer_id": i} for i in range(400)
        ],
        "raw_recharge__charges": [{"id": i, "subscription_id": key(), "status": "SUCCESS", "total_price": 1.0} for i in range(100)],
    }
    plain, split = project(spark, settings, **tables), project(spark, replace(settings, rows_per_task=60), **tables)
    for name in ("dim_customers", "fct_subscriptions", "rpt_subscription_health"):
        same(getattr(plain, name), getattr(split, name))


def test_customers_with_very_many_orders(spark, settings):
    rng = random.Random(1)
    orders = [
        order(i, customer=rng.choice([1, 1, None, rng.randrange(2, 30)]), day=f"2024-0{rng.randrange(1, 7)}-10",
              time=f"12:{rng.randrange(60):02d}:00", site=rng.choice(["/", utm("a"), utm("b", "c")]))
        for i in range(1500)
    ]
    tables = {"raw_shopify__orders": orders, "raw_shopify__customers": [{"id": i, "email": str(i)} for i in range(1, 30)]}
    plain = project(spark, settings, **tables)
    split = project(spark, replace(settings, rows_per_task=100), **tables)
    assert not plain.hot_customers and {r.key for r in split.hot_customers.keys.collect()} == {1, None}
    for name in ("int_orders__enriched", "fct_orders"):
        same(getattr(plain, name), getattr(split, name))


def test_first_touch_has_one_answer_whatever_the_sizes(spark, settings, tmp_path):
    """Undated orders come last: in the default plan, with hot customers, and in the written tables."""
    rng = random.Random(8)
    orders = [
        {**order(i, customer=1 + i % 7, day=f"2024-0{rng.randrange(1, 7)}-10", site=rng.choice(["/", utm("a"), utm("b", "c"), utm("d")])),
         **({"created_at": None} if i < 14 or i % 5 == 0 else {})}
        for i in range(120)
    ]
    orders += [{**order(200 + i, customer=8, site=utm("e")), "created_at": None} for i in range(3)]  # no dated order at all
    tables = {"raw_shopify__orders": orders, "raw_shopify__customers": [{"id": i, "email": str(i)} for i in range(1, 9)]}
    plain = project(spark, settings, **tables)
    split = project(spark, replace(settings, rows_per_task=1), **tables)
    built = build(project(spark, settings, **tables), ParquetSink(spark, str(tmp_path)))
    assert split.hot_customers and not plain.hot_customers
    for other in (split, built):
        same(plain.fct_orders, other.fct_orders.select(plain.fct_orders.columns))
        same(plain.dim_customers, other.dim_customers)
        same(plain.rpt_monthly_cohort_retention, other.rpt_monthly_cohort_retention)
    first = {r.customer_id: r.acquisition_channel for r in plain.dim_customers.collect()}
    dated = [o for o in orders if o["customer_id"] == 1 and o["created_at"] and "utm" in (o["landing_site"] or "")]
    earliest = min(dated, key=lambda o: (o["created_at"], o["id"]))
    wanted = by(plain.int_orders__enriched, "order_id")[earliest["id"]].channel
    assert first[1] == wanted and first[8] == "e / (none)"
