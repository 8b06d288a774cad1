from __future__ import annotations

import random

import numpy as np
import pytest
from odd import rows_of
from pyspark.sql import functions as F

import corpus_pipeline
from subledger.llm import toxicity
from subledger.llm.common import held_out
from subledger.llm.toxicity import Training, fit, keep_clean, score, sentences, swap_terms, train

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(~held_out(F.col("doc_id")))
    return train(docs, spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_documents(spark, model):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    found = score(docs, model).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    toxic, clean = [r for r in found if r.toxic == 1], [r for r in found if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)  # 37 toxic documents to learn from, five of them not English


def test_sentence_scores_are_those_of_split_sentences(model):
    scorer = model.scorer()
    rng = random.Random(3)
    assert scorer["idiot"] > 0
    for _ in range(50):
        text = "".join(rng.choices(["idiot ", "word ", "other ", ".", "!?", "\n", "7 ", "x-y "], k=rng.randint(0, 200)))
        slow = [sum(scorer[w] for w in set(s)) + model.intercept for s in sentences(text, model.training.sentence_words)]
        np.testing.assert_allclose(scorer.sentence_scores(text), slow, atol=1e-9)


def test_the_counterfactual_penalty_spares_neutral_mentions():
    """Insults in training mention one group more often than others: without the penalty its name becomes toxic."""
    rng = random.Random(1)
    filler = [f"word{n}" for n in range(60)]
    rows = []
    for n in range(600):
        toxic = n % 2
        words = rng.choices(filler, k=8)
        if toxic:
            words += ["stupid"] if rng.random() < 0.6 else []
            words += ["muslims"] if rng.random() < 0.8 else []
        elif rng.random() < 0.05:
            words += ["muslims"]
        rows.append((words, toxic))
    plain, fair = (fit(rows, Training(fairness=f)).scorer() for f in (0.0, 30.0))
    neutral = "Muslims met word1 word2 word3"
    assert fair.score(neutral) < 0.5 < plain.score(neutral)
    other = neutral.replace("Muslims", "Jews")
    assert abs(fair.score(neutral) - fair.score(other)) < abs(plain.score(neutral) - plain.score(other))
    assert fair.score("stupid word1 word2") > 0.5


def test_swapping():
    assert swap_terms(["the", "women", "and", "men"], toxicity.IDENTITY_TERMS) == [["the", "men", "and", "girls"], ["the", "and"]]
    assert swap_terms(["nobody"], toxicity.IDENTITY_TERMS) == []


def test_odd_rows(spark, odd_documents, model):
    found = score(odd_documents, model)
    assert found.columns == ["doc_id", "score", "predicted"] and found.count() == odd_documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.collect())
    empty = {r.score for r in found.filter("doc_id in (2, 3, 4)").collect()}
    assert len(empty) == 1 and empty.pop() < 0.3
    assert score(odd_documents.limit(0), model).collect() == []
    assert keep_clean(odd_documents, model).columns == odd_documents.columns


def test_training_without_use(spark, odd_documents):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (7, 5), (99, 1)], "doc_id bigint, toxic int")
    for labels in (none, odd):
        made = train(odd_documents, labels)
        found = score(odd_documents, made).collect()
        assert len({r.score for r in found}) == 1 and all(r.score <= 0.25 + 1e-12 and r.predicted == 0 for r in found)
        assert rows_of(keep_clean(odd_documents, made)) == rows_of(odd_documents)


def test_labels_of_held_out_rows_change_nothing(spark, model):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = train(docs.filter(~held_out(F.col("doc_id"))), turned)
    np.testing.assert_array_equal(again.weights, model.weights)


@pytest.mark.parametrize("toxic", [[], [0] * 40, [1] * 40, [0, 1] * 20, [1, 1, 1, 0] * 10, [None] * 40])
def test_without_evidence_the_stage_keeps_all(spark, tmp_path, toxic):
    """Labels of one kind or none, or of both on texts that do not differ, at the production threshold."""
    docs = spark.createDataFrame([(n, f"Plain words in a row. Others follow {'abc'[n % 3]}.", "x") for n in range(42)], "doc_id bigint, text string, kept string")
    rows = list(enumerate(toxic))
    if len(set(toxic)) > 1:
        docs = docs.withColumn("text", F.lit("Plain words in a row. Others follow."))
    spark.createDataFrame(rows, "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)["toxicity"]
    assert rows_of(stage(spark, docs, str(tmp_path))) == rows_of(docs)
    found = score(docs, train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))).collect()
    assert len({r.score for r in found}) == 1 and all(r.score < 0.3 and r.predicted == 0 for r in found)


def test_predicted_follows_the_score(spark, model):
    """Whatever the model: one that knows nothing and has a high intercept calls all texts toxic, as its scores do."""
    plain = toxicity.Model(np.zeros(1 << 17), 0.0, Training())
    docs = spark.createDataFrame([(1, "plain words"), (2, "plain idiot"), (3, None)], "doc_id bigint, text string")
    for made in (plain, model, toxicity.held(plain)):
        assert all(r.predicted == int(r.score >= 0.3) for r in score(docs, made).collect())


def test_a_high_intercept_is_held(spark):
    """Training never leaves a text without evidence at 0.3 or more; known words still count."""
    model = toxicity.Model(np.zeros(1 << 17), 0.4, Training())
    model.weights[toxicity.Features(1 << 17)("idiot")] = 0.5
    docs = spark.createDataFrame([(1, "plain words"), (2, "plain idiot"), (3, None)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in score(docs, toxicity.held(model)).collect()}
    assert {i: r.predicted for i, r in found.items()} == {1: 0, 2: 1, 3: 0} and found[1].score == found[3].score < 0.3
    assert {r.doc_id for r in keep_clean(docs, toxicity.held(model)).collect()} == {1, 3}
    calm = toxicity.Model(model.weights, -3.0, Training())
    assert toxicity.held(calm).intercept == -3.0


def test_scores_over_the_documents_are_those_of_split_sentences(spark, model):
    """Every document of a whole table against the worst of its sentences, summed word by word."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts, scorer = {r.doc_id: r.text for r in docs.collect()}, model.scorer()
    found = score(docs, model).collect()
    assert len(found) == docs.count()
    for r in found:
        sums = [sum(scorer[w] for w in set(s)) + model.intercept for s in sentences(texts[r.doc_id], model.training.sentence_words)]
        assert abs(r.score - 1 / (1 + np.exp(-max(sums, default=model.intercept)))) < 1e-9


def test_scores_mean_the_same_beyond_the_caps(spark):
    """One document in 8 is toxic, by a word that as many clean ones hold: a sample of as many of each must not forget it."""
    rng = random.Random(2)
    rows = []
    for n in range(3200):
        words = rng.choices([f"word{m}" for m in range(30)], k=8) + (["odd"] if n % 8 < 2 else [])
        rows.append((n, " ".join(words), int(n % 8 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    whole, capped = (train(docs, docs.select("doc_id", "toxic"), Training(most_per_label=m)).scorer() for m in (5000, 300))
    for text in ("word1 word2 word3", "word1 odd word2"):
        assert abs(whole.score(text) - capped.score(text)) < 0.15, (text, whole.score(text), capped.score(text))
