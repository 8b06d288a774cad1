from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from subledger.llm import token_counts
from subledger.llm.pretokens import Counter, Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = Counter(PATH, {})
HARD = [
    "", " ", "It's THE dog's, they'll've", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|><|endoftext|>", "É é ñ ß ẞ İ ı Σ ΑΣ ς",
    "中文字符 and 日本語 한국어", "👍🏽 zero​width “quotes” — dash…", "x\x1cy\x1fz\x00q\x85r s", "՘ଁ ₏꟎ 𐲀", "１２３ ⅷ ½ 123456",
    "''''s's 's", "!'s !!'re",
]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_ids_are_the_librarys(encoder):
    import numpy as np

    for text in HARD:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected(text), text


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_counts_of_any_text(text):
    assert COUNTER.count(text) == len(expected(text))


def test_every_disputed_character_takes_the_librarys_way(encoder):
    import numpy as np

    for start in range(1, 0x11000, 7):
        if not 0xD800 <= start < 0xE000:
            text = f"a{chr(start)}B1{chr(start)}"
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected(text), hex(start)


def test_counts_of_a_table(spark):
    long = "Thousand words " * 40_000
    rows = [(1, t, "x") for t in HARD] + [(None, "null id", "x"), (3, None, "x"), (4, long, "x"), (4, long, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    got = sorted(map(tuple, token_counts.count_tokens(df, PATH, limit=10).collect()), key=str)
    want = [(i, len((t or "").encode()), len(expected(t or "")), len(expected(t or "")) > 10) for i, t, _ in rows]
    assert got == sorted(want, key=str)
    assert token_counts.count_tokens(df.limit(0), PATH).collect() == []


def test_the_broadcast_table_changes_no_count(spark):
    frequent = token_counts.frequent_pieces(spark.createDataFrame([(t,) for t in HARD], "text string"), PATH)
    assert frequent
    counter = Counter(PATH, frequent)
    assert [counter.count(t) for t in HARD] == [len(expected(t)) for t in HARD]


def test_what_a_worker_remembers_is_bounded_and_changes_nothing(monkeypatch):
    import random

    import numpy as np

    monkeypatch.setattr("subledger.llm.pretokens.CACHE_ENTRIES", 20)
    encoder, rng = Encoder(PATH), random.Random(1)
    for _ in range(300):
        text = " ".join(rng.choices([f"word{n}x{n}" for n in range(40)] + HARD, k=rng.randint(0, 12)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected(text), text
        assert len(encoder.known) <= 20 + 100 and len(encoder.older) <= 20 + 100
