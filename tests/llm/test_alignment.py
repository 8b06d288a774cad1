"""Alignment of two tokenizers against whole texts given to both libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from functools import reduce

import public_tokenizers
import pytest
import sentencepiece
from odd import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from subledger.llm import alignment
from subledger.llm.alignment import EMPTY, Pair, align, combine, parts_of, ranges
from subledger.llm.queries import ALIGNED, op12_token_alignment

PATHS = [public_tokenizers.path(name) for name in ALIGNED]
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
BOTH = Pair(*PATHS)
HARD = [
    "Plain words, it's 12 o'clock.", " leading", "trailing ", "two  spaces", "\n new\n\nlines \t tabs ", "x 's 've", "É é ñ ß 中文字 日本 한국", "👍🏽 zero​width “q” —",
    "a<|endoftext|>b <s> </s> <0x41> <unk>", "literal ▁ mark", "x▁ y", "a b 　 c d", "ẽ combining  ̈x ́", "\x00\x01 \x7f x", "   ", "a᠎b ᠎ c", "é" * 30, "a",
]


def tokens(text):
    """Ids and byte ends of either, or None."""
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    bytes_a, bytes_b = [BOTH.bytes_a[n] for n in a], [BOTH.bytes_b[n] for n in b]
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    return a, alignment._ends(bytes_a), b, alignment._ends(bytes_b)


def slow(text):
    """Groups as text, counts, and linked pairs."""
    if (found := tokens(text)) is None:
        return None
    a, ends_a, b, ends_b = found
    by_end = dict(zip(ends_b, b))
    links = [(x, by_end[end]) for x, end in zip(a, ends_a) if end in by_end]
    cut = [0] * (ends_a[-1] + 1)  # the number of the group that a byte offset ends in
    common = set(ends_a) & set(ends_b)
    for end in range(1, len(cut)):
        cut[end] = cut[end - 1] + (end - 1 in common)
    groups = [([], []) for _ in common]
    for side, (ids, ends) in enumerate(((a, ends_a), (b, ends_b))):
        for n, end in zip(ids, ends):
            groups[cut[end]][side].append(str(n))
    return ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups), len(a), len(b), len(groups), links


def brute(rows):
    found = [(i, slow(t)) for i, t in rows]
    count = Counter(p for _, f in found if f for p in f[4])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted((
        (i, f[1], f[2], f[3], len(f[4]), sum(count[p] == most[p[1]] for p in f[4]), sum(count[p] for p in f[4]), hashlib.sha256(f[0].encode()).hexdigest())
        if f else (i, 0, 0, 0, 0, 0, 0, "") for i, f in found
    ), key=str)


def pairs(links):
    import numpy as np

    return [divmod(int(n), BOTH.size_b) for n in np.frombuffer(links, BOTH.kind)]


def same(text):
    want, got = slow(text), BOTH.whole(text.encode())
    assert (got is None) == (want is None), text
    if want:
        assert (got.groups, got.n_a, got.n_b, got.n_links, pairs(got.links)) == (*want[:4], want[4]), text


def test_words_give_the_tokens_of_whole_texts():
    for text in HARD:
        same(text)
    assert sum(slow(t) is None for t in HARD) == 2


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t.'é中ab1  　"), st.characters(exclude_categories=["Cs"])), min_size=1, max_size=40))
def test_any_text(text):
    same(text)


def by_ranges(text, size):
    raw = b" " + text.encode()
    found = ranges(raw, size)
    assert [r[0] for r in found] + [len(raw)] == [0] + [r[1] for r in found]
    return [BOTH.fragment(raw[first:last], start - first, end - first) for start, end, first, last in found]


@pytest.mark.parametrize("size", [7, 16, 40, 1000])
def test_ranges_anywhere(size):
    """Whatever the size of ranges, and however their fragments are bracketed."""
    rng = random.Random(size)
    words = ["the", "internationalisation", "it's", "中文字", "naïve", "12345", "zxqj", "a  b", "\n\n", "“x”", "Überraschung"]
    for _ in range(15):
        text = " ".join(rng.choices(words, k=60))
        parts, want = by_ranges(text, size), slow(text)
        while len(parts) > 1:
            at = rng.randrange(len(parts) - 1)
            parts[at : at + 2] = [combine(*parts[at : at + 2])]
        whole = parts[0]
        groups = f"{whole.head_a}|{whole.head_b}" + (f";{whole.body}" if whole.body else "")
        assert whole.tail_a == whole.tail_b == "" and (groups, whole.n_a, whole.n_b, whole.n_links) == want[:4]
        assert pairs(whole.links) == want[4]


def test_ranges_have_open_ends_and_nothing_is_a_neutral_element():
    parts = by_ranges("internationalisation Überraschung zxqjzxqj " * 20, 16)
    assert len(parts) > 10 and any(p.tail_a or p.tail_b for p in parts)
    for p in parts:
        assert combine(EMPTY, p) == p == combine(p, EMPTY)
    assert reduce(combine, parts) == combine(reduce(combine, parts[:4]), reduce(combine, parts[4:]))


def test_texts_without_safe_spaces_are_one_range():
    assert len(ranges(b" " + b"x" * 1000, 16)) == 1 and len(ranges(b" " + b"x  " * 1000, 16)) == 1
    assert parts_of(b" a b") == [b" a", b" b"] and parts_of(b"  a b ") == [b"  a", b" b "]


def rows_for(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)


@pytest.mark.parametrize("frequent", [40, 0])
def test_all_frequent_and_rare_pairs(spark, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    texts = [*HARD, "the cat and the dog", "the The the", "Plain words, it's 12 o'clock."]
    assert rows_of(align(rows_for(spark, texts), *PATHS)) == brute(list(enumerate(texts)))


def test_long_documents_across_tasks(spark, monkeypatch):
    """Ranges of a few bytes: several levels of the tree."""
    monkeypatch.setattr(alignment, "RANGE", 24)
    monkeypatch.setattr(alignment, "FAN", 3)
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["the", "internationalisation", "中文字", "naïve", "a  b"], k=k)) for k in (1, 3, 30, 150)]
    texts += ["x" * 500, "long enough but with a literal ▁ mark somewhere in it", texts[2]]
    assert rows_of(align(rows_for(spark, texts), *PATHS)) == brute(list(enumerate(texts)))


def test_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert rows_of(op12_token_alignment(spark, "/root/testdata/sf0.001")) == brute([(r.doc_id, r.text) for r in docs])


def test_odd_rows(spark, odd_documents):
    found = align(odd_documents, *PATHS)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(found) == brute([(r.doc_id, r.text) for r in odd_documents.collect()])
    assert align(odd_documents.limit(0), *PATHS).collect() == []
