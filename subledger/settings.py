"""Business constants. Every one is an argument; the defaults are the published model's values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Settings:
    # The shop prints New-York wall clock; the two other systems print UTC.
    shop_timezone: str = "America/New_York"

    # "Now" for open durations; None means the time the query runs.
    as_of: dt.datetime | None = None

    # Date dimension, end exclusive.
    spine_start: dt.date = dt.date(2023, 12, 1)
    spine_end: dt.date = dt.date(2026, 6, 30)

    # Days covered by the subscription report, both ends included.
    report_start: dt.date = dt.date(2024, 1, 1)
    report_end: dt.date = dt.date(2025, 12, 31)

    # Order and charge may differ by this much and still match.
    amount_tolerance: Decimal = Decimal("0.01")
    # Months whose shop and payment revenue differ by a larger share are flagged.
    variance_threshold: Decimal = Decimal("0.02")

    # Upper day limits of the two subscription tiers, and the days of an MRR month.
    short_interval_days: int = 30
    long_interval_days: int = 90
    mrr_days: Decimal = Decimal("30.0")
    # A zero charge interval fails the job ("error") or gives no MRR ("null").
    zero_interval: str = "error"

    # Data-quality limits: freshness in days, monthly revenue agreement.
    recency_days: int = 3
    revenue_agreement: Decimal = Decimal("0.05")

    # A failed charge counts as recovered when the same subscription is charged within this many days.
    dunning_days: int = 30

    # An order and a payment that names none may be this far apart to be taken for each other.
    match_amount: Decimal = Decimal("5.00")
    match_days: int = 45

    # Rows of one key a single task should take on; keys above it are split.
    rows_per_task: int = 2_000_000
