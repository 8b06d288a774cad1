"""Dates. Months are DATE columns holding the first day; timestamps are zone-free UTC."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def wall_clock(text: Column) -> Column:
    """The printed date and time; a trailing zone offset is ignored."""
    return text.cast("timestamp_ntz")


def zone_to_utc(text: Column, zone: str) -> Column:
    """Read the printed wall clock as local time of ``zone``, daylight saving included, and move it to UTC.

    In a UTC session, the rule here, ``to_utc_timestamp`` does this; it looks the zone up once, ``convert_timezone`` for
    every row.
    """
    wall = wall_clock(text)
    if SparkSession.active().conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC"):
        return F.to_utc_timestamp(wall.cast("timestamp"), zone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)


def month_of(when: Column) -> Column:
    return F.trunc(when, "month")


def days_between(start: Column, end: Column) -> Column:
    """Midnights passed, not whole 24-hour spans."""
    return F.datediff(end, start)


def months_between(start: Column, end: Column) -> Column:
    """Month starts passed, not whole months."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def utc_now() -> Column:
    """The current instant as a zone-free time in UTC, counted from the epoch so that no session zone comes into it."""
    return F.expr(
        "timestamp_ntz'1970-01-01 00:00:00' "
        "+ make_dt_interval(0, 0, 0, cast(unix_micros(current_timestamp()) as decimal(20, 0)) / 1000000)"
    )
