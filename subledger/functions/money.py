"""Exact decimal money."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for the revenue of hundreds of billions of orders, with 14 digits left for the quotient.
_OPERAND = "decimal(24,6)"


def money(amount: Column) -> Column:
    return amount.cast("decimal(10,2)")


def cents_to_dollars(cents: Column) -> Column:
    return money(cents / F.lit(Decimal("100.0")))


def safe_divide(numerator: Column, denominator: Column, places: int = 4) -> Column:
    """The rounded quotient; null instead of an error when there is nothing to divide by."""
    return F.when(
        denominator != 0,
        F.round(numerator.cast(_OPERAND) / denominator.cast(_OPERAND), places),
    )
