"""Operators Spark has no single call for, composed from DataFrame operations."""

from subledger.operators.dedup import keep_first, row_digest
from subledger.operators.intervals import month_deltas, running_levels
from subledger.operators.skew import HotKeys, find_hot_keys, left_join_few, left_join_many, number_rows
from subledger.operators.spine import date_spine, day_spine, month_spine
from subledger.operators.timeline import as_of_join, carry_forward, neighbour, valid_at, versions, with_late_changes

__all__ = [
    "HotKeys", "as_of_join", "carry_forward", "date_spine", "day_spine", "find_hot_keys", "keep_first", "left_join_few",
    "left_join_many", "month_deltas", "month_spine", "neighbour", "number_rows", "row_digest", "running_levels", "valid_at",
    "versions", "with_late_changes",
]
