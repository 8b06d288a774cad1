"""Toxicity: a linear classifier of sentences, held to the same score whichever group a sentence mentions.

Documents are labelled, not sentences, and one toxic sentence makes a document toxic. So a document's score is that of its
worst sentence, and training alternates between finding each labelled document's worst sentence and fitting a logistic
regression to those sentences. Only features that toxic documents hold significantly more often take part: a document has
many sentences, and chance weights on rare words would make the worst of them look bad. For every training sentence that
mentions an identity term, counterfactual copies are made, one with another term of the same group and one that names
none, and the squared differences of the scores are added to the loss: the first makes groups alike, the second keeps the
mention itself from counting.

Words count by themselves and by their beginnings, so inflected and compound forms of a known word count as well.
"""

from __future__ import annotations

import logging
import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import keep_rows, per_batch
from subledger.session import materialized

_log = logging.getLogger(__name__)

#: Words are runs of letters; the rest of the pattern ends a sentence.
_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]+")
#: Groups of terms that may stand for each other: who is mentioned must not matter. Fixed values.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "homosexual", "queer"),
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "cisgender", "nonbinary"),
    ("immigrant", "citizen", "refugee", "foreigner", "native"),
    ("immigrants", "citizens", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "autistic"),
    ("mexican", "chinese", "american", "russian", "indian", "german", "french", "turkish", "polish"),
    ("christen", "muslime", "juden", "hindus", "atheisten"),
    ("frauen", "männer"),
    ("chrétiens", "musulmans", "juifs", "athées"),
    ("femmes", "hommes"),
    ("cristianos", "musulmanes", "judíos", "ateos"),
    ("mujeres", "hombres"),
)


@dataclass(frozen=True)
class Training:
    """``most_per_label`` bounds the labelled documents of either label that are learned from, chosen by hash of their id.
    Two sentences of each reach the driver, of at most ``sentence_words`` words: longer ones are cut into such windows.
    A sampled document of either label counts for as many as it stands for, so that scores mean the same at every size.
    """

    most_per_label: int = 5000
    sentence_words: int = 40
    buckets: int = 1 << 17
    rounds: int = 2
    steps: int = 120
    decay: float = 1e-5
    #: Likelihood ratio (G squared) from which on a feature counts as significant.
    evidence: float = 15.0
    #: Weight of the squared score difference between a sentence and its counterfactual.
    fairness: float = 1.0
    #: The most that a sentence without evidence may score.
    most_prior: float = 0.25
    groups: Sequence[Sequence[str]] = field(default=IDENTITY_TERMS)


class Features:
    """Hashed features of a word: itself, and its beginnings of 3 to 6 letters."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.known = buckets, {}

    def __call__(self, word: str) -> np.ndarray:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 300_000:
                self.known.clear()
            marks = [f"={word}", *(word[:n] for n in range(3, 7) if len(word) >= n)]
            found = self.known[word] = np.array([zlib.crc32(m.encode()) % self.buckets for m in marks], np.int64)
        return found


def sentences(text: str | None, longest: int) -> Iterator[list[str]]:
    sentence: list[str] = []
    for token in _TOKEN.findall((text or "").lower()):
        if token[0] in ".!?\n" or len(sentence) == longest:
            if sentence:
                yield sentence
            sentence = []
        if token[0] not in ".!?\n":
            sentence.append(token)
    if sentence:
        yield sentence


class Model:
    """Weights per bucket and an intercept. Made from arrays, so that it is as small to send as they are."""

    def __init__(self, weights: np.ndarray, intercept: float, training: Training) -> None:
        self.weights, self.intercept, self.training = weights, intercept, training

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """A worker's side of the model: remembers the weights of words."""

    def __init__(self, model: Model) -> None:
        self.model, self.features, self.known = model, Features(model.training.buckets), {}

    def __getitem__(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 400_000:
                self.known.clear()
            found = self.known[word] = float(self.model.weights[self.features(word)].sum())
        return found

    def sentence_scores(self, text: str | None) -> np.ndarray:
        """Log-odds of each sentence, in order. A word counts once in a sentence."""
        tokens = _TOKEN.findall((text or "").lower())
        if not tokens:
            return np.empty(0)
        ends = np.fromiter((t[0] in ".!?\n" for t in tokens), bool, len(tokens))
        values = np.fromiter((0.0 if e else self[t] for t, e in zip(tokens, ends)), np.float64, len(tokens))
        # A window starts after each end, and after every so many words without one.
        number = np.arange(len(tokens))
        starts = np.maximum.accumulate(np.where(ends, number + 1, 0))
        starts = np.concatenate([[0], starts[:-1]])
        begins = (number - starts) % self.model.training.sentence_words == 0
        window, seen = np.cumsum(begins), set()
        for at in np.flatnonzero(values).tolist():  # few words have a weight
            if (word := (window[at], tokens[at])) in seen:
                values[at] = 0
            seen.add(word)
        sums = np.add.reduceat(values, np.flatnonzero(begins))
        some = np.add.reduceat((~ends).astype(np.int64), np.flatnonzero(begins))
        return sums[some > 0] + self.model.intercept

    def score(self, text: str | None) -> float:
        """Probability of the worst sentence; a text without words has that of no evidence."""
        scores = self.sentence_scores(text)
        worst = scores.max() if len(scores) else self.model.intercept
        return float(1 / (1 + np.exp(-np.clip(worst, -30, 30))))


def swap_terms(sentence: Sequence[str], groups: Sequence[Sequence[str]]) -> list[list[str]]:
    """The sentence with each identity term replaced by the next of its group, and without them; none if it has none."""
    following = {t: g[(at + 1) % len(g)] for g in groups for at, t in enumerate(g)}
    if not any(w in following for w in sentence):
        return []
    return [[following.get(w, w) for w in sentence], [w for w in sentence if w not in following]]


class _Rows:
    """Sparse rows of feature numbers."""

    def __init__(self, rows: Sequence[Sequence[str]], features: Features) -> None:
        found = [np.concatenate([features(w) for w in dict.fromkeys(r)]) if r else np.empty(0, np.int64) for r in rows]
        self.count, self.buckets = len(rows), features.buckets
        self.columns = np.concatenate([*found, np.empty(0, np.int64)])
        self.row = np.repeat(np.arange(len(rows)), [len(f) for f in found])

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.columns], self.count)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, errors[self.row], self.buckets)


def fit(
    labelled: Sequence[tuple[Sequence[str], int]], training: Training, allowed: np.ndarray | None = None,
    stands_for: Sequence[float] = (1.0, 1.0),
) -> Model:
    """Logistic regression on sentences with the counterfactual penalty, by full-batch Adam, on the ``allowed`` buckets.

    A sentence of a document labelled 0 or 1 counts ``stands_for`` of its label times.
    """
    features = Features(training.buckets)
    plain = [s for s, _ in labelled]
    pairs = [(s, w) for s in plain for w in swap_terms(s, training.groups)]
    rows = _Rows(plain, features)
    own, swapped = _Rows([s for s, _ in pairs], features), _Rows([w for _, w in pairs], features)
    target = np.array([y for _, y in labelled], float)
    weight = np.where(target == 1, stands_for[1], stands_for[0])
    weights, intercept = np.zeros(training.buckets), 0.0
    mean, square = np.zeros(training.buckets + 1), np.zeros(training.buckets + 1)
    for step in range(1, training.steps + 1 if len(target) else 1):
        guess = 1 / (1 + np.exp(-np.clip(rows.times(weights) + intercept, -30, 30)))
        error = (guess - target) * weight / weight.sum()
        slope = rows.back(error) + training.decay * weights
        if pairs:
            apart = 2 * training.fairness * (own.times(weights) - swapped.times(weights)) / len(pairs)
            slope += own.back(apart) - swapped.back(apart)
        if allowed is not None:
            slope[~allowed] = 0
        slope = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights -= move[:-1]
        intercept -= move[-1]
    return Model(weights, float(intercept), training)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, training: Training, key: str, text: str
) -> tuple[DataFrame, tuple[float, float]]:
    """Texts and labels learned from, written once, and how many labelled documents of the whole table one of either label
    stands for. ``docs`` must not hold rows that nothing may be learned from.

    Ids with null, unknown or contradicting labels are left out. The ids are chosen before any text is read; of rows that
    repeat an id one is taken, so that the sample stays bounded.
    """
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_id")).agg(F.min("toxic").alias("_y"), F.max("toxic").alias("_z"))
        .filter("_y = _z").select("_id", "_y")
    )
    there = known.join(docs.select(F.col(key).alias("_id")), "_id", "left_semi").withColumn("_h", F.xxhash64("_id"))
    totals = {r["_y"]: r["count"] for r in there.groupBy("_y").count().collect()}
    stands_for = tuple(max(1.0, totals.get(y, 0) / training.most_per_label) for y in (0, 1))
    few = [there.filter(F.col("_y") == y).orderBy("_h", "_id").limit(training.most_per_label) for y in (0, 1)]
    chosen = materialized(few[0].unionByName(few[1]).select("_id", "_y"))
    # At most twice most_per_label ids: small by definition.
    found = docs.select(F.col(key).alias("_id"), F.col(text).alias("_t")).join(F.broadcast(chosen), "_id")
    texts = found.groupBy("_id", "_y").agg(F.min_by("_t", F.xxhash64("_t")).alias("_t")).select("_t", "_y")
    return materialized(texts), stands_for


def first_weights(sample: DataFrame, training: Training) -> Model:
    """Log-odds of each bucket that toxic documents hold significantly more often than others, 0 for all other buckets:
    enough to tell which sentence is a document's worst.

    Tasks send one count per bucket, so the driver gets at most ``buckets`` rows whatever the sample's texts.
    """

    def count(batches):
        features, seen = Features(training.buckets), np.zeros((2, training.buckets), np.int64)
        for batch in batches:
            for body, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {w for s in sentences(body, training.sentence_words) for w in s}
                if found:
                    seen[label, np.unique(np.concatenate([features(w) for w in found]))] += 1
        for at in range(0, training.buckets, 10_000):
            where = at + np.flatnonzero(seen[:, at : at + 10_000].any(0))
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(seen[0, where]), pa.array(seen[1, where])], names=["b", "no", "yes"])

    rows = sample.coalesce(16).mapInArrow(count, "b bigint, no bigint, yes bigint").groupBy("b").sum("no", "yes").collect()
    totals = {r["_y"]: r["count"] for r in sample.groupBy("_y").count().collect()}
    weights = np.zeros(training.buckets)
    if rows:
        where, no, yes = np.array(rows, float).T
        n_yes, n_no = totals.get(1, 0), totals.get(0, 0)
        odds = np.log((yes + 0.5) / (n_yes + 1)) - np.log((no + 0.5) / (n_no + 1))
        weights[where.astype(int)] = np.where((odds > 0) & (_likelihood_ratio(yes, no, n_yes, n_no) >= training.evidence), odds, 0)
    return Model(weights, 0.0, training)


def _likelihood_ratio(yes: np.ndarray, no: np.ndarray, n_yes: int, n_no: int) -> np.ndarray:
    """How much better two rates explain the counts than a common one."""
    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-9)), 0)

    rate = (yes + no) / max(1, n_yes + n_no)
    return 2 * (part(yes, n_yes * rate) + part(n_yes - yes, n_yes * (1 - rate)) + part(no, n_no * rate) + part(n_no - no, n_no * (1 - rate)))


def train(docs: DataFrame, labels: DataFrame, training: Training = Training(), key: str = "doc_id", text: str = "text") -> Model:
    """A model from the labelled documents among ``docs``. Without evidence of both labels every score is their smoothed
    share of toxic ones; the score of no evidence is never over ``Training.most_prior``.
    """
    sample, stands_for = labelled_sample(docs, labels, training, key, text)
    model = first_weights(sample, training)
    allowed = model.weights > 0
    if not allowed.any():
        return _ignorant(training, stands_for, sample)
    for turn in range(training.rounds):
        sent = sample.sparkSession.sparkContext.broadcast(model)

        def worst(turn=turn, sent=sent):
            scorer, longest = sent.value.scorer(), training.sentence_words

            def choose(batch):
                out, labels = [], []
                for body, label in zip(batch["_t"], batch["_y"]):
                    found = list(sentences(body, longest))
                    if not found:
                        continue
                    sums = [sum(scorer[w] for w in dict.fromkeys(s)) for s in found]
                    picks = {int(np.argmax(sums))}
                    if label == 0:  # and one that says nothing in particular
                        picks.add(zlib.crc32(body.encode("utf-8", "surrogatepass")) % len(found))
                    out += [" ".join(found[p]) for p in sorted(picks)]
                    labels += [label] * len(picks)
                return {"s": out, "y": labels}

            return choose

        rows = per_batch(sample, ["_t", "_y"], worst, "s string, y int").collect()
        labelled = [(r.s.split(" "), r.y) for r in sorted(rows)]
        if len({y for _, y in labelled}) < 2:
            return _ignorant(training, stands_for, sample)
        model = fit(labelled, training, allowed, stands_for)
    return held(model)


def held(model: Model) -> Model:
    """The same with the score of no evidence at ``most_prior`` or less: what says nothing must not be condemned, however
    many of the labelled sentences are toxic. All scores move alike, so their order stays.
    """
    most = model.training.most_prior
    return Model(model.weights, min(model.intercept, math.log(most / (1 - most))), model.training)


def _ignorant(training: Training, stands_for: tuple[float, float], sample: DataFrame) -> Model:
    """Every score is the share of toxic documents among the labelled ones, one of either kind added, and held."""
    _log.warning("No evidence of what toxic documents have more often than others: all texts score alike")
    totals = {r["_y"]: r["count"] for r in sample.groupBy("_y").count().collect()}
    clean, toxic = (1 + totals.get(y, 0) * stands_for[y] for y in (0, 1))
    return held(Model(np.zeros(training.buckets), math.log(toxic / clean), training))


def score(df: DataFrame, model: Model, threshold: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score (0 to 1) and predicted (1 from ``threshold`` on, else 0) of every document.

    Whole texts are scored. A null or empty text, or one without letters, has the score of a sentence without evidence.
    Repeated rows are scored each and alike, an empty table gives no rows, other columns are not looked at.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = sent.value.scorer()
        return lambda batch: {"id": batch["id"], "score": [scorer.score(t) for t in batch["t"]]}

    kind = df.schema[key].dataType.simpleString()
    scored = per_batch(df, [df[key].alias("id"), df[text].alias("t")], make, f"id {kind}, score double")
    return scored.select(F.col("id").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(df: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The documents that score below ``threshold``, all their columns unchanged.

    Null and empty texts score as texts without evidence and stay; repeated rows are judged alike, an empty table stays
    empty, columns of any name are passed on.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = sent.value.scorer()
        return lambda batch: [scorer.score(t) < threshold for t in batch[text]]

    return keep_rows(df, [text], make)
