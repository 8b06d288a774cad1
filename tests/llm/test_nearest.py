from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from subledger.llm.nearest import Settings, encode, estimates, index, rotation, search

SF = "/root/testdata/sf0.01"


def brute(ids, vectors, asked, k=20):
    out = {}
    for q in asked:
        scores = vectors @ vectors[q]
        others = [n for n in np.lexsort((ids, -scores)) if n != q][:k]
        out[int(ids[q])] = [(int(ids[n]), float(scores[n])) for n in others]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_a_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = brute(ids, vectors, np.flatnonzero(ids % 20 == 0))
    codes = index(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert codes.count() == len(rows)
    for settings in (Settings(), Settings(block=100, queries=7, sample=50)):
        got = found(search(codes, F.col("key") % 20 == 0, settings))
        assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
        hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
        assert hits >= 0.98 * 20 * len(want)
        for q, near in got.items():
            for i, score in near:
                assert abs(score - float(vectors[ids == i][0] @ vectors[ids == q][0])) < 1e-12


def test_estimates_and_bounds():
    rng = np.random.default_rng(2)
    vectors, queries = rng.standard_normal((3000, 64)) * rng.uniform(0.1, 5, (3000, 1)), rng.standard_normal((20, 64))
    turn = rotation(64, 1)
    np.testing.assert_allclose(turn @ turn.T, np.eye(64), atol=1e-9)
    bits, lengths, along = encode(vectors, turn)
    assert bits.shape == (3000, 8)
    guess, off = estimates(queries, bits, lengths, along, turn, 3.0)
    error = guess - queries @ vectors.T
    assert abs((error / off).mean()) < 0.02 and (np.abs(error) > off).mean() < 0.01


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
        (6, [3.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (0, [1.0, 1.0]), (None, [1.0, 0.0]), (40, None), (9, [-1.0, 0.0]), (10, []),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, key string")
    assert sorted(r.key for r in index(df).collect()) == [0, 0, 7, 8, 9, 20]
    got = search(index(df), F.col("key") % 20 == 0)
    rows = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())
    assert [r[1:] for r in rows if r[0] == 20] == [(1, 0, 2.0), (2, 0, 0.0), (3, 7, 0.0), (4, 8, 0.0), (5, 9, 0.0)]
    assert len([r for r in rows if r[0] == 0]) == 10  # both rows with id 0 ask, and may find each other
    assert search(index(df.limit(0)), F.col("key") % 20 == 0).collect() == []


def test_a_vector_held_by_most_rows(spark):
    rows = [(n, [1.0, 2.0, 3.0] if n % 3 else [float(n), 1.0, 0.0]) for n in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = found(search(index(df), F.col("key") % 20 == 0, Settings(block=64, queries=4, sample=30)))
    ids, vectors = np.arange(300), np.array([v for _, v in rows])
    want = brute(ids, vectors, np.flatnonzero(ids % 20 == 0))
    assert {q: [i for i, _ in n] for q, n in got.items()} == {q: [i for i, _ in n] for q, n in want.items()}
