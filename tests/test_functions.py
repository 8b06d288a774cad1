from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subledger import functions as fn


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_shop_clock_follows_daylight_saving_and_ignores_the_printed_offset(rows):
    df = rows("t string", ("2024-07-01T00:00:00-05:00",), ("2024-01-01T00:00:00-05:00",), (None,))
    assert one(df, fn.zone_to_utc(F.col("t"), "America/New_York")) == [
        dt.datetime(2024, 7, 1, 4), dt.datetime(2024, 1, 1, 5), None
    ]


def test_shop_clock_is_the_same_in_any_session_zone(spark, rows):
    hours = [f"2024-{m:02d}-{d:02d}T{h:02d}:30:00-05:00" for m, d in ((3, 10), (11, 3), (7, 4)) for h in range(24)]
    df = rows("t string", *[(t,) for t in hours])
    in_utc = one(df, fn.zone_to_utc(F.col("t"), "America/New_York").cast("string"))
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert one(df, fn.zone_to_utc(F.col("t"), "America/New_York").cast("string")) == in_utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert in_utc[2] == "2024-03-10 07:30:00" and in_utc[24 + 1] == "2024-11-03 05:30:00"  # skipped and doubled hours


def test_wall_clock_drops_the_zone(rows):
    df = rows("t string", ("2024-07-01T10:00:00Z",), ("2024-07-01T10:00:00-05:00",))
    assert one(df, fn.wall_clock(F.col("t"))) == [dt.datetime(2024, 7, 1, 10)] * 2


def test_days_and_months_count_boundaries(rows):
    df = rows(
        "a timestamp_ntz, b timestamp_ntz",
        (dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1)),
        (dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 1)),
        (dt.datetime(2023, 12, 31), dt.datetime(2025, 1, 1)),
    )
    assert one(df, fn.days_between(F.col("a"), F.col("b"))) == [1, 1, 367]
    assert one(df, fn.months_between(F.col("a"), F.col("b"))) == [0, 1, 13]


def test_months_are_dates(rows):
    df = rows("t timestamp_ntz", (dt.datetime(2024, 2, 29, 23, 59),)).select(fn.month_of(F.col("t")).alias("m"))
    assert df.schema["m"].dataType.simpleString() == "date"
    assert df.first().m == dt.date(2024, 2, 1)


@pytest.mark.parametrize("n, d, expected", [
    (1, 3, Decimal("0.3333")), (2, 3, Decimal("0.6667")), (1, 0, None), (1, None, None), (None, 2, None),
    (-1, 3, Decimal("-0.3333")), (1, 20000, Decimal("0.0001")), (10**15, 10**15, Decimal("1.0000")),
])
def test_safe_divide(rows, n, d, expected):
    assert one(rows("n bigint, d bigint", (n, d)), fn.safe_divide(F.col("n"), F.col("d"))) == [expected]


def test_safe_divide_holds_the_revenue_of_very_many_orders(rows):
    df = rows("n decimal(38,2), d decimal(38,2)", (Decimal("500000000000000.00"), Decimal("1000000000000000.00")))
    assert one(df, fn.safe_divide(F.col("n"), F.col("d"))) == [Decimal("0.5000")]


def test_cents_and_money_round_half_up(rows):
    assert one(rows("c bigint", (3239,), (5,), (0,), (None,)), fn.cents_to_dollars(F.col("c"))) == [
        Decimal("32.39"), Decimal("0.05"), Decimal("0.00"), None
    ]
    assert one(rows("x double", (1.005,), (29.994,)), fn.money(F.col("x"))) == [Decimal("1.01"), Decimal("29.99")]


def test_url_parameters(rows):
    df = rows(
        "u string", ("/?utm_source=google&utm_medium=cpc",), ("/?utm_source=&utm_medium=cpc",), ("/?utmXsource=q",), ("/",),
        (None,), ("/?utm_medium=a%20b&x=1",), ("/?utm_source=a&utm_source=b",), ("/?utm_source=autm_source=b",),
    )
    assert one(df, fn.url_parameter(F.col("u"), "utm_source")) == ["google", "", "", None, None, None, "a", "a"]
    assert one(df, fn.url_parameter(F.col("u"), "utm_medium")) == ["cpc", "cpc", None, None, None, "a%20b", None, None]


def test_blanks(rows):
    df = rows("x string", (" a ",), ("  ",), ("",), (None,))
    assert one(df, fn.blank_to_null(F.col("x"))) == [" a ", None, None, None]
    assert one(df, fn.blank_to_null(F.col("x"), F.upper(F.trim("x")))) == ["A", None, None, None]
    assert one(df, fn.is_blank(F.col("x"))) == [False, True, True, True]


def test_flags_are_never_null(rows):
    assert one(rows("x string", ("a",), ("b",), (None,)), fn.flag(F.col("x") == "a")) == [True, False, False]


def test_names_are_capitalised_after_every_word_break(rows):
    df = rows("x string", (" mary-jane o'NEIL ",), ("anna maria",), ("",), (None,), ("(dr.) who_is",))
    assert one(df, fn.proper_name(F.col("x"))) == ["Mary-Jane O'neil", "Anna Maria", "", None, "(Dr.) Who_Is"]
