from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from odd import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from subledger.llm import jaccard_join
from subledger.llm.jaccard_join import Settings, Shingler, components, join, keep_one, paths, sketch

SF = "/root/testdata/sf0.01"


def grams(text, n=5):
    words = (text or "").split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows):
    """Classes and links of (id, text) rows, by comparing all different texts."""
    texts = sorted({t for _, t in rows if grams(t)})
    sets = [grams(t) for t in texts]
    parent, links = list(range(len(texts))), [0] * len(texts)
    holders = defaultdict(list)
    for n, s in enumerate(sets):
        for g in s:
            holders[g].append(n)

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for b in holders[g]:
                if b > a:
                    shared[b] += 1
        for b, n in shared.items():
            if 10 * n >= 8 * (len(s) + len(sets[b]) - n):
                links[a] += 1
                links[b] += 1
                parent[top(b)] = top(a)
    where = {t: n for n, t in enumerate(texts)}
    classes, per = defaultdict(list), {}
    for i, t in rows:
        if t in where:
            classes[top(where[t])].append(str(i))
        per.setdefault(str(i), []).append(links[where[t]] if t in where else 0)
    return sorted(map(sorted, classes.values())), {k: sorted(v) for k, v in per.items()}


def found(df):
    classes, per = defaultdict(list), {}
    for r in df.collect():
        if r.class_id is not None:
            classes[r.class_id].append(str(r.doc_id))
        per.setdefault(str(r.doc_id), []).append(r.n_links)
    return sorted(map(sorted, classes.values())), {k: sorted(v) for k, v in per.items()}


@pytest.mark.parametrize("options", [Settings(), Settings(small=4, block=16, exact_block=8)])
def test_whole_table_against_all_pairs(spark, options):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(join(docs, options)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def variants(seed, many, changes, length=120):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(many):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(length)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_large_group_of_near_copies_and_a_common_passage(spark):
    """Blocks, deeper levels, and a passage that every text shares without making them alike."""
    passage = " ".join(f"p{n}" for n in range(40))
    texts = variants(1, 150, 3) + variants(2, 40, 4) + [passage + " " + t for n in range(120) for t in variants(100 + n, 1, 0)]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id bigint, text string")
    options = Settings(small=8, block=32, exact_block=16)
    assert found(join(docs, options)) == brute(list(enumerate(texts)))


def test_recall_of_the_paths_alone():
    """A pair at the threshold meets in some leaf about as often as promised."""
    rng, options, missed = random.Random(4), Settings(recall=0.98), 0
    for _ in range(400):
        common = [rng.getrandbits(64) for _ in range(160)]
        pair = [np.unique(np.array(common + [rng.getrandbits(64) for _ in range(20)], np.uint64)) for _ in range(2)]
        leaves = [{tuple(p) for p in paths(s, options) if len(p) == options.depth} for s in pair]
        missed += not leaves[0] & leaves[1]
    assert missed <= 0.04 * 400


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 3000), st.floats(0.3, 1))
def test_sketches_estimate(size, share):
    rng = np.random.default_rng(size)
    tokens = np.unique(rng.integers(1, 2**63, 2 * size, dtype=np.uint64))
    both = max(1, int(len(tokens) * share))
    extra = len(tokens) - both
    a, b = tokens[: both + extra // 2], np.concatenate([tokens[:both], tokens[both + extra // 2 :]])
    bits = [np.unpackbits(np.frombuffer(sketch(x, Settings()), np.uint8)) for x in (a, b)]
    real = both / len(tokens)
    assert abs((1 - 2 * (bits[0] != bits[1]).mean()) - real) < 0.25


def test_components(spark):
    rng, many = random.Random(5), 300
    links = [(rng.randrange(many), rng.randrange(many)) for _ in range(200)] + [(n, n + 1) for n in range(1000, 1060)] + [(7, 7)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    parent = list(range(2000))

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    assert {r.node: r.root for r in got} == {n: top(n) for a, b in links if a != b for n in (a, b)} and len(got) == len({r.node for r in got})


def test_shingles():
    shingle = Shingler(5)
    assert len(shingle("a b c d e f")) == 2 and len(shingle("a b")) == 1 and len(shingle(" \n")) == 0 and len(shingle(None)) == 0
    assert shingle("a b c\td  e").tolist() == shingle("a b c d e").tolist() != shingle("a b c e d").tolist()


def test_odd_rows(spark, odd_documents):
    got = join(odd_documents)
    assert got.columns == ["doc_id", "class_id", "n_links", "n_copies"] and got.count() == odd_documents.count()
    assert {(r.class_id, r.n_links, r.n_copies) for r in got.filter("doc_id in (2, 3, 4)").collect()} == {(None, 0, 0)}
    assert [r.n_copies for r in got.filter("doc_id = 1").collect()] == [1, 1]
    assert join(odd_documents.limit(0)).collect() == []
    kept = keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "7", "8", "9", "None", "None"])
    assert keep_one(odd_documents.limit(0)).collect() == []


def test_the_smallest_key_of_a_class_stays(spark):
    texts = variants(9, 6, 1)
    rows = [(None, texts[0], "n"), (5, texts[1], "a"), (3, texts[2], "b"), (3, texts[2], "b"), (8, "on its own", "c"), (9, texts[0], None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, class_id string")
    assert rows_of(keep_one(df)) == sorted([(3, texts[2], "b"), (8, "on its own", "c")], key=str)


def test_runs_follow_the_recall():
    assert Settings(recall=0.5).runs() < Settings().runs() and jaccard_join.Settings(depth=1).meeting() > Settings().meeting()


def test_words_of_one_length_stay_apart(spark):
    """Texts of one word are one token each: ids of 64 bits that hold fewer would take different words for one."""
    docs = spark.createDataFrame([(1, "3807458072"), (2, "9086789562"), (3, "3807458072")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in join(docs).collect()}
    assert found[1].class_id == found[3].class_id != found[2].class_id and found[2].n_links == 0
    assert sorted(r.doc_id for r in keep_one(docs).collect()) in ([1, 2], [2, 3])
