"""Column expressions shared by the plans. All of them are built from Spark's own functions."""

from subledger.functions.calendar import days_between, month_of, months_between, utc_now, wall_clock, zone_to_utc
from subledger.functions.money import cents_to_dollars, money, safe_divide
from subledger.functions.text import blank_to_null, clean_email, flag, is_blank, proper_name, url_parameter

__all__ = [
    "blank_to_null", "cents_to_dollars", "clean_email", "days_between", "flag", "is_blank", "money", "month_of",
    "months_between", "proper_name", "safe_divide", "url_parameter", "utc_now", "wall_clock", "zone_to_utc",
]
