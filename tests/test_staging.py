"""Edge rows, one per trap of the source data."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from raw import raw
from subledger.plans import staging


def test_the_earliest_delivery_of_an_order_stays(spark, settings):
    df = staging.shop_orders(raw(
        spark, "raw_shopify__orders",
        {"id": 1, "created_at": "2024-01-01T10:00:09-05:00", "total_price": 2.0},
        {"id": 1, "created_at": "2024-01-01T10:00:00-05:00", "total_price": 1.0},
        {"id": 1, "created_at": None, "total_price": 3.0},
        {"id": 2, "created_at": None, "total_price": 9.0},
        {"id": 2, "created_at": None, "total_price": 8.0},
    ), settings)
    found = {r.order_id: r.gross_revenue for r in df.collect()}
    assert found[1] == D("1.00") and found[2] in (D("8.00"), D("9.00"))  # of undated copies, that of smaller digest


def test_order_columns(spark, settings):
    order = staging.shop_orders(raw(spark, "raw_shopify__orders", {
        "id": 1, "email": " A@B.Com ", "created_at": "2024-07-01T22:00:00-05:00", "total_price": 32.239999,
        "total_discounts": 3.0, "total_tax": 1.5, "source_name": "subscription_contract",
        "landing_site": "/?utm_source=google", "cancelled_at": "2024-07-02T00:00:00-05:00",
    }), settings).first()
    assert order.customer_email == "a@b.com"
    assert order.order_created_at_utc == dt.datetime(2024, 7, 2, 2)
    assert (order.gross_revenue, order.discount_amount, order.net_revenue) == (D("32.24"), D("3.00"), D("29.24"))
    assert order.is_subscription_order is True
    assert (order.utm_source, order.utm_medium) == ("google", None)
    assert order.cancelled_at == "2024-07-02T00:00:00-05:00"


def test_unknown_source_is_no_subscription(spark, settings):
    assert staging.shop_orders(raw(spark, "raw_shopify__orders", {"id": 1}), settings).first().is_subscription_order is False


def test_customers_are_unique_by_email_and_the_latest_stays(spark, settings):
    df = staging.shop_customers(raw(
        spark, "raw_shopify__customers",
        {"id": 1, "email": "x@y.z", "created_at": "2024-01-01T00:00:00-05:00"},
        {"id": 2, "email": " X@Y.z ", "created_at": "2024-02-01T00:00:00-05:00", "accepts_marketing": "True", "state": " ny "},
        {"id": 3, "email": "n@y.z", "created_at": "2024-02-01T00:00:00-05:00"},
        {"id": 4, "email": "n@y.z", "created_at": None},
        {"id": 5, "email": None, "created_at": "2024-01-01T00:00:00-05:00"},
        {"id": 6, "email": None, "created_at": "2024-03-01T00:00:00-05:00"},
    ), settings)
    got = {r.shopify_customer_id: r for r in df.collect()}
    assert set(got) == {2, 4, 6}  # an undated record ranks as latest; records without e-mail share one place
    assert got[2].accepts_marketing is True and got[4].accepts_marketing is False
    assert got[2].billing_state == "NY"


def test_line_item_amounts(spark):
    item = staging.shop_line_items(raw(
        spark, "raw_shopify__order_line_items", {"id": 1, "order_id": 1, "price": 29.99, "quantity": 3, "total_discount": 4.5},
    )).first()
    assert (item.gross_line_amount, item.net_line_amount) == (D("89.97"), D("85.47"))


@pytest.mark.parametrize("status, cancelled_at, expected, mismatch", [
    ("active", "2024-02-01T00:00:00Z", "cancelled", True),
    ("active", "  ", "active", False),
    ("active", None, "active", False),
    ("Active", "2024-02-01T00:00:00Z", "active", False),
    ("EXPIRED", "2024-02-01T00:00:00Z", "expired", False),
    (None, "2024-02-01T00:00:00Z", None, False),
])
def test_status_mismatch(spark, settings, status, cancelled_at, expected, mismatch):
    df = raw(spark, "raw_recharge__subscriptions", {"id": 1, "status": status, "cancelled_at": cancelled_at})
    got = staging.subscriptions(df, settings).first()
    assert (got.subscription_status, got.had_status_mismatch) == (expected, mismatch)


def test_frequency_tiers(spark, settings):
    df = raw(spark, "raw_recharge__subscriptions", *[
        {"id": i, "charge_interval_frequency": days} for i, days in enumerate([7, 30, 31, 90, 91, None])
    ])
    got = [r.subscription_frequency_tier for r in staging.subscriptions(df, settings).orderBy("subscription_id").collect()]
    assert got == ["30-day", "30-day", "90-day", "90-day", "other", "other"]


def test_error_categories(spark):
    messages = ["Card DECLINED: insufficient", "Insufficient funds", "card expired", "requires update", "timeout", " ", None]
    df = raw(spark, "raw_recharge__charges", *[{"id": i, "error_message": m} for i, m in enumerate(messages)])
    got = [r.error_category for r in staging.subscription_charges(df).orderBy("charge_id").collect()]
    assert got == [
        "card_declined", "insufficient_funds", "card_expired", "payment_method_update_needed", "other_error", None, None
    ]


def test_charge_outcomes(spark):
    df = raw(spark, "raw_recharge__charges", *[
        {"id": i, "status": s, "type": "recurring"} for i, s in enumerate(["success", "Error", "DECLINED", "queued", None])
    ])
    got = staging.subscription_charges(df).orderBy("charge_id").collect()
    assert [(r.is_successful_charge, r.is_failed_charge) for r in got] == [
        (True, False), (False, True), (False, True), (False, False), (False, False)
    ]
    assert got[0].charge_type == "RECURRING"


def test_ghost_failures(spark):
    df = raw(
        spark, "raw_stripe__charges",
        {"id": "a", "status": "failed", "amount": 1000, "amount_refunded": 250},
        {"id": "b", "status": "failed", "metadata_shopify_order_id": 1},
        {"id": "c", "status": "failed", "metadata_recharge_charge_id": 1},
        {"id": "d", "status": "succeeded"},
        {"id": "e", "status": None},
    )
    got = staging.payment_charges(df).orderBy("stripe_charge_id").collect()
    assert [r.is_ghost_failure for r in got] == [True, False, False, False, False]
    assert [r.is_successful for r in got] == [False, False, False, True, False]
    assert (got[0].charge_amount, got[0].refunded_amount, got[0].net_charge_amount) == (D("10.00"), D("2.50"), D("7.50"))


def test_refund_reasons(spark):
    df = raw(spark, "raw_stripe__refunds", *[
        {"id": str(i), "reason": r, "amount": 591} for i, r in enumerate(["", None, " Duplicate ", "fraudulent"])
    ])
    got = staging.payment_refunds(df).orderBy("stripe_refund_id").collect()
    assert [r.refund_reason for r in got] == ["not_specified", "not_specified", "duplicate", "fraudulent"]
    assert got[0].refund_amount == D("5.91")


def test_subscription_customers(spark):
    got = staging.subscription_customers(raw(
        spark, "raw_recharge__customers",
        {"id": 1, "email": " A@b.c", "status": "ACTIVE", "has_payment_method_in_dunning": "TRUE", "created_at": "2024-01-01T05:00:00Z"},
    )).first()
    assert (got.customer_email, got.recharge_status, got.is_in_dunning) == ("a@b.c", "active", True)
    assert got.recharge_created_at_utc == dt.datetime(2024, 1, 1, 5)
