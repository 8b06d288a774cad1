"""Ranked search against scores of all documents for all items."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import pytest
from odd import LONG, rows_of

from subledger.llm import ranked_search
from subledger.llm.queries import ORACLE_SQL, op13_ranked_search
from subledger.llm.ranked_search import rank, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    tallies = [(i, Counter(slow_terms(t))) for i, t in docs]
    tallies = [(i, c) for i, c in tallies if c]
    many, length = len(tallies), sum(c.total() for _, c in tallies)
    holding = Counter(t for _, c in tallies for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(slow_terms(text)), []
        for doc, c in tallies:
            m = 100 - 25 + 25 * c.total() * many // length
            score = sum(
                q * math.floor(1000 * math.log((2 * many + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, q in asked.items() if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc if doc is not None else 0))
        out += [(item, n, None if none else doc, -s) for n, (s, none, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, many=400):
    rng = random.Random(seed)
    vocabulary = [f"W{n}" for n in range(60)]
    weights = [1 / (n + 1) for n in range(60)]
    docs = [(n if rng.random() < 0.97 else None, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 2, 5, 30])))) for n in range(many)]
    items = [(n, " ".join(rng.choices([*vocabulary, "unknown"], k=rng.randint(0, 9)))) for n in range(25)]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("seed, block, k", [(1, 8192, 20), (2, 16, 5), (3, 40, 1)])
def test_equals_all_scores(spark, monkeypatch, seed, block, k):
    """With one block and many; short documents give many ties."""
    monkeypatch.setattr(ranked_search, "BLOCK_DOCUMENTS", block)
    docs, items = corpus(seed)
    assert rows_of(rank(*frames(spark, docs, items), k=k)) == brute(docs, items, k)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_CHARS", 200)
    docs, items = corpus(4, 150)
    assert rows_of(rank(*frames(spark, docs, items))) == brute(docs, items)


def test_accumulators_are_limited():
    """Common terms make none once rare ones have filled the best; a later block starts from the score to beat."""
    import numpy as np
    import pyarrow as pa

    def block(first):
        times = [np.array([9], np.uint32) if n < 30 else np.array([1], np.uint32) for n in range(1000)]
        own = [np.array([0], np.uint32) if n < 30 else np.array([1], np.uint32) for n in range(1000)]
        return pa.RecordBatch.from_arrays(
            [pa.array(range(first, first + 1000)), pa.array([10] * 1000), pa.array([o.tobytes() for o in own]), pa.array([t.tobytes() for t in times])],
            names=["id", "n", "terms", "times"],
        )

    search = ranked_search.Search([np.array([1, 0])], [np.array([1, 1])], ranked_search.Corpus(2000, 20_000, np.array([60, 1940])), 20)
    search.add([block(0)])
    assert search.made == 30
    search.add([block(1000)])
    assert search.made == 60 and search.best[0][1] == list(range(20))


def test_terms():
    for text in ("It's É-é ÀB中文x_y2 3.5\x7f\x80ÿ", "", None, "İI", "a\x00b"):
        assert [t.decode() for t in terms(text)] == slow_terms(text)


def test_damping_beyond_64_bits():
    import numpy as np

    big = ranked_search.Corpus(5 * 10**10, 5 * 10**13, np.array([1]))
    assert big.damping(np.array([10**8, 1000])).tolist() == [75 + 25 * n * 5 * 10**10 // (5 * 10**13) for n in (10**8, 1000)]


def test_the_table_and_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = rows_of(op13_ranked_search(spark, folder))
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    assert found == brute([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in items])
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    assert sorted(duck.execute(ORACLE_SQL["op13_ranked_search"]).fetchall(), key=str) == found


def test_odd_rows(spark, odd_documents):
    items = spark.createDataFrame(
        [(1, "words READ", "x"), (1, "words READ", "x"), (2, None, "x"), (3, "", "x"), (None, "body", "x"), (4, LONG, "x"), (5, "中文 👍", "x")],
        "item_id int, text string, score string",
    )
    found = rank(odd_documents, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert rows_of(found) == brute(docs, [(r.item_id, r.text) for r in items.collect()])
    assert rank(odd_documents.limit(0), items).collect() == [] == rank(odd_documents, items.limit(0)).collect()
