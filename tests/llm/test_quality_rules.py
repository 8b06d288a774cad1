from __future__ import annotations

import base64
import random
import re
from collections import Counter
from pydoc_data.topics import topics

from odd import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from subledger.llm.quality_rules import Bands, BaseRules, Judge, duplicate_lines, keep_good, quality, recoded, repeated_words

SF = "/root/testdata/sf0.01"


def slow_repeated(words, n=3):
    windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    counts = Counter(windows)
    return len({i + d for i, w in enumerate(windows) if counts[w] > 1 for d in range(n)})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_words(words):
    assert repeated_words(words) == slow_repeated(words)


def test_duplicate_lines():
    assert duplicate_lines("a\nb\na\n\n\n \n \na b\na\n") == 2


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeated = slow_repeated(words)
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)
    return (
        len(words), sum(len(w) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
        sum(line in lines[:n] for n, line in enumerate(lines)), repeated, failed,
    )


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = quality(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r)[1:7] == slow(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)
    judged = [r for r in found if labels.get(r.doc_id) is not None and not r.base_failed]
    assert all(r.kept for r in judged if labels[r.doc_id] == 1)  # clean documents stay
    bad = [r.kept for r in judged if labels[r.doc_id] == 0]
    assert sum(bad) < 0.75 * len(bad)


def test_odd_rows(spark, odd_documents):
    found = quality(odd_documents)
    assert found.count() == odd_documents.count()
    assert {r.n_words for r in found.filter("doc_id in (2, 3, 4)").collect()} == {0}
    assert [(r.n_words, r.base_failed, r.kept) for r in found.filter("doc_id = 7").collect()] == [(210_000, True, False)]
    assert quality(odd_documents.limit(0)).collect() == []
    assert keep_good(odd_documents).columns == odd_documents.columns and keep_good(odd_documents).count() == 0


def prose(n, seed=0):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnoprstu", k=rng.randint(2, 9))) for _ in range(800)]
    return " ".join(rng.choices(vocabulary, k=n))


def test_bands():
    judge, loose = Judge(Bands(), BaseRules()), BaseRules(most_repeated=100)
    loose = Judge(Bands(), loose)
    assert judge.figures(prose(300))["kept"]
    assert not loose.figures("the same line again and again\n" * 100)["kept"]
    noise = base64.b85encode(random.Random(1).randbytes(6000)).decode()
    assert not judge.figures(" ".join(noise[i : i + 9] for i in range(0, len(noise), 9)))["kept"]
    # Half of the chunks are one line over and over; the other half is prose.
    mixed = prose(9000) + "\n" + "\n".join(f"item {n % 5} of the list" for n in range(6000))
    assert loose.figures(mixed)["bad_chunk_share"] > 0.5 and not loose.figures(mixed)["kept"]


def test_filter_keeps_all_columns(spark):
    text = prose(300)
    df = spark.createDataFrame([(1, text, None, "x"), (1, text, None, "x"), (2, "short", "en", "y")], "doc_id bigint, text string, lang string, kept string")
    assert rows_of(keep_good(df)) == [(1, text, None, "x")] * 2


def other_letters(text, first, step):
    """The text with its Latin letters exchanged one for one."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    upper = {ord(c.upper()): chr(first + n + step) for n, c in enumerate(letters)}
    return text.translate({ord(c): chr(first + n) for n, c in enumerate(letters)} | upper)


def test_clean_documents_in_other_alphabets_stay(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").join(labels, "doc_id").collect()]
    judge, seen = Judge(Bands(), BaseRules()), 0
    for text in texts:
        latin = judge.figures(text)
        for first, step in ((0x430, -32), (0x905, 0)):  # Cyrillic; Devanagari, without case
            found = judge.figures(other_letters(text, first, step))
            assert found["kept"] or found["base_failed"]
            seen += latin["kept"]
    assert seen > 400


def test_formal_texts_stay():
    """Pages of a manual repeat their turns and shrink better than invented prose."""
    judge = Judge(Bands(), BaseRules())
    found = [judge.figures(t) for t in topics.values()]
    judged = [f for f in found if not f["base_failed"] and f["n_symbols"] <= 0.4 * f["n_words"]]
    assert len(judged) > 40 and all(f["kept"] for f in judged)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é ж中👍", max_size=60))
def test_recoding_keeps_what_equals_what(text):
    short, sizes = recoded(text)
    assert sizes is None or sizes.tolist() == [1] * len(text)
    assert len(short) == len(text) and [short.index(c) for c in short] == [text.index(c) for c in text]


def test_recoding_of_wide_alphabets():
    many = "".join(map(chr, [*range(0x4E00, 0x4E00 + 9000), 0x1F44D]))
    short, sizes = recoded("abc" + many + "é" * 9)
    assert set(sizes.tolist()) == {1, 2, 4} and len(short) == sizes.sum()
    starts = [sum(sizes[:n]) for n in (0, 1, 2)]
    assert bytes(short[s] for s in starts) == b"abc" and short.endswith(b"\x80" * 9)
    parts = [short[e - s : e] for s, e in zip(sizes.tolist(), sizes.cumsum().tolist())]
    assert len(set(parts)) == 3 + 9001 + 1
