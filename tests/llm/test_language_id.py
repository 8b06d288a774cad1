from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from subledger.llm.common import held_out
from subledger.llm.language_id import predict, train

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet(f"{SF}/documents.parquet").filter(~held_out(F.col("doc_id"))))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = predict(docs, model).join(docs, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    right = [r.lang_pred == r.lang for r in found]
    assert len(right) > 200 and sum(right) >= 0.97 * len(right)
    assert all(0 <= r.score <= 1 for r in found)


def test_families_come_first(model):
    assert model.families == [["de", "en"], ["es", "fr"]] and model.pairs == [("de", "en"), ("es", "fr")]
    assert model.weights.shape[1] == 2 + 2


def test_odd_rows(spark, odd_documents, model):
    found = {(r.doc_id, r.lang_pred, r.score) for r in predict(odd_documents, model).collect()}
    assert {(2, "und", 0.0), (3, "und", 0.0), (4, "und", 0.0), (8, "und", 0.0)} <= found
    assert {p for i, p, _ in found if i in (1, 7)} <= {"en", "de", "fr", "es"} and predict(odd_documents, model).count() == 11
    assert predict(odd_documents.limit(0), model).collect() == []


def test_few_or_no_languages(spark, odd_documents):
    assert {r.lang_pred for r in predict(odd_documents, train(odd_documents.limit(0))).collect()} == {"und"}
    one = spark.createDataFrame([(n, "just some words", "xx") for n in range(5)], "doc_id bigint, text string, lang string")
    assert {(r.lang_pred, r.score) for r in predict(one, train(one)).collect()} == {("xx", 1.0)}


def test_an_unlisted_language_is_a_family(spark):
    rows = [(n, text, lang) for n in range(30) for text, lang in (
        ("the house and the garden", "en"), ("das haus und der garten", "de"), ("qaq zuq xexq qux", "tlh"))]
    docs = spark.createDataFrame([(3 * n + k, *r[1:]) for n, r in enumerate(rows) for k in (0,)], "doc_id bigint, text string, lang string")
    made = train(docs)
    assert sorted(map(sorted, made.families)) == [["de", "en"], ["tlh"]]
    assert {(r.lang, r.lang_pred) for r in predict(docs, made).join(docs, "doc_id").collect()} == {(x, x) for x in ("en", "de", "tlh")}
