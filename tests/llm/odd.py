"""What the tests of several operators use."""

from __future__ import annotations

LONG = "Long texts are read as a whole. " * 30_000


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)
