from __future__ import annotations

import importlib
import sys
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from odd import rows_of
from test_jaccard_join import brute
from test_mixing import targets_by_hand
from tokenizers import Tokenizer

import corpus_pipeline
from subledger.llm.quality_rules import Bands, BaseRules, Judge
from subledger.session import run_folder

SF = "/root/testdata/sf0.01"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returned, written and read again as the driver does."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = f"{run_folder(spark)}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_return_documents(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(kept)[1:]
    for name in list(kept)[1:-1]:
        assert kept[name].dtypes == kept["documents"].dtypes


def test_quality(kept):
    judge = Judge(Bands(), BaseRules())
    wanted = Counter(r.doc_id for r in kept["documents"].collect() if judge.figures(r.text)["kept"])
    assert ids(kept["quality_rules"]) == wanted


def test_toxicity(spark, kept):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = ids(kept["quality_rules"]) - ids(kept["toxicity"])
    assert not ids(kept["toxicity"]) - ids(kept["quality_rules"])
    assert sum(labels.get(d) == 0 for d in gone) <= 0.02 * sum(ids(kept["quality_rules"]).values())
    stayed = [labels[d] for d in ids(kept["toxicity"]) if d in labels]
    assert sum(stayed) <= 0.05 * len(stayed)


def test_one_of_each_class(kept):
    rows = [(r.doc_id, r.text) for r in kept["toxicity"].collect()]
    classes, _ = brute(rows)
    wanted = Counter(min(map(int, c)) for c in classes)
    assert ids(kept["ngram_jaccard_join"]) == wanted


def test_mixing(kept):
    docs = kept["ngram_jaccard_join"].collect()
    times = ids(kept["source_mixing"])
    size, of = {r.doc_id: len(r.text.split()) for r in docs}, defaultdict(list)
    for r in docs:
        of[r.source].append(r.doc_id)
    assert set(times.values()) <= {1, 2} and set(times) <= set(size)
    order = sorted(of)
    for source, target in zip(order, targets_by_hand([sum(size[d] for d in of[s]) for s in order])):
        assert abs(sum(times[d] * size[d] for d in of[source]) - target) <= max(0.02 * target, 10)


def test_packing(kept):
    texts = {r.doc_id: r.text for r in kept["source_mixing"].collect()}
    times, found = ids(kept["source_mixing"]), kept["best_fit_packing"].collect()
    tokens = defaultdict(int)
    for r in found:
        tokens[r.doc_id] += r.length
    for d, n in times.items():
        assert tokens[d] == n * (len(LIBRARY.encode(texts[d], add_special_tokens=False).ids) + 1)
    filled = defaultdict(list)
    for r in found:
        filled[r.sequence_id].append((r.offset, r.length))
    for slots in filled.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(slots), sorted(slots)[1:])) and sum(n for _, n in slots) <= 4096


def test_run_applies_the_stages(spark, kept):
    found = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(found.select(columns)) == rows_of(kept["best_fit_packing"].select(columns))


def test_empty_documents(spark, kept, odd_documents):
    for docs in (kept["documents"].limit(0), odd_documents):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            if name != "best_fit_packing":
                assert out.columns == docs.columns and len(rows) <= 2 * docs.count()


def test_the_other_queries_do_without(monkeypatch):
    """As if both were deleted: the entry point offers the rest."""
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.setitem(sys.modules, "subledger.llm", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    assert "fct_orders" in entry.queries() and "pipeline" not in entry.queries() and "op1_url_filters" not in entry.oracle_sql()
    monkeypatch.delitem(sys.modules, "__spark_entry__")
