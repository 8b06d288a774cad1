from __future__ import annotations

import pytest
from odd import LONG


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and columns named like results."""
    rows = [
        (1, "Plain words in a row.", "en", "a", 1, "x"), (1, "Plain words in a row.", "en", "a", 1, "x"), (2, None, "de", "b", 2, "x"),
        (3, "", None, None, 3, None), (4, " \n\t ", "fr", "a", None, "x"), (None, "Nobody's text", "en", "a", 5, "x"),
        (None, "Nobody's text", "en", "a", 5, "x"), (None, None, None, None, None, None), (7, LONG, "en", "b", 7, "x"),
        (8, "12 34 !!", "es", "c", 8, "x"), (9, "ж 中文 👍", "es", "c", 9, "x"),
    ]
    names = "doc_id bigint, text string, lang string, source string, "
    return spark.createDataFrame(rows, names + "size bigint, kept string").selectExpr(
        "*", "kept as score", "kept as n_tokens", "kept as offset", "kept as sequence_id", "kept as class_id", "kept as id", "kept as t",
        "kept as held_out", "kept as target", "kept as digest", "kept as path",
    )
