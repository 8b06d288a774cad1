"""Language by two steps: the family first, then one linear SVM for each pair of languages within it.

What tells German from French is not what tells German from Dutch. So one-versus-rest machines over families decide the
family, and only its languages stand against each other, every pair by a machine trained on that pair alone; most votes
win. Features are the hashed runs of one to four letters of each word, the space at either end included, averaged over a
text. They are taken from the array of its characters, all runs of a length at once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import per_batch
from subledger.session import materialized

UNKNOWN = "und"
_WORD, _BETWEEN = re.compile(r"[^\W\d_]+"), re.compile(r"[\W\d_]+")
_RUNS = (1, 2, 3, 4)
#: Characters taken at once; longer texts are cut between words, which changes no run.
_PART = 200_000
#: Families of languages by code. A language that is not listed is a family of its own. Fixed values.
FAMILIES: dict[str, tuple[str, ...]] = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "yi", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "celtic": ("ga", "gd", "cy", "br"),
    "turkic": ("tr", "az", "kk", "ky", "uz", "tk", "tt"),
    "indo-aryan": ("hi", "bn", "pa", "gu", "mr", "ne", "ur", "si"),
    "dravidian": ("ta", "te", "kn", "ml"),
    "semitic": ("ar", "he", "am", "mt"),
    "sinitic": ("zh", "yue"),
    "austronesian": ("id", "ms", "tl", "jv", "su"),
}


@dataclass(frozen=True)
class Training:
    """``per_language`` bounds the documents learned from for each language, ``languages`` their number (the most frequent
    count); of each document two windows of ``windows`` words reach the driver.
    """

    per_language: int = 1200
    languages: int = 200
    windows: Sequence[int] = (6, 50)
    buckets: int = 1 << 14
    steps: int = 80
    decay: float = 1e-4
    families: Mapping[str, Sequence[str]] = field(default_factory=lambda: FAMILIES)


def runs(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all runs of a text's letters, part by part."""
    plain = _BETWEEN.sub(" ", f" {text.lower()} ")
    at = 0
    while at < len(plain) - 1:
        end = plain.find(" ", at + _PART)
        end = len(plain) - 1 if end < 0 else end
        letters = np.frombuffer(plain[at : end + 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        gap = letters == ord(" ")
        found, key = [], np.zeros(len(letters), np.uint64)
        inside = np.ones(len(letters), bool)  # no gap but at the ends of the run
        for n in _RUNS:
            key = (key[: len(letters) - n + 1] + letters[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            if n > 2:
                inside = inside[: len(key)] & ~gap[n - 2 : n - 2 + len(key)]
            use = ~gap if n == 1 else inside[: len(key)]
            found.append((key[use] >> np.uint64(40)) % np.uint64(buckets))
        yield np.concatenate(found).astype(np.int64)
        at = end


@dataclass
class Model:
    """``machines`` weights (buckets x machines) and intercepts: the families in order, then the pairs of each family."""

    languages: list[str]
    families: list[list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    intercepts: np.ndarray


def svm(rows: Sequence[np.ndarray], targets: np.ndarray, training: Training) -> tuple[np.ndarray, np.ndarray]:
    """Linear machines by squared hinge, one per column of ``targets`` (1, -1, or 0 where a row takes no part)."""
    numbers = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    columns = np.concatenate(rows)
    values = np.repeat([20 / max(1, len(r)) for r in rows], [len(r) for r in rows])
    size = (training.buckets, targets.shape[1])
    weights, intercepts = np.zeros(size), np.zeros(size[1])
    for machine in range(size[1]):
        use = targets[:, machine] != 0
        y = targets[:, machine]
        share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * use
        mean, square = np.zeros(size[0] + 1), np.zeros(size[0] + 1)
        w, b = weights[:, machine], 0.0
        for step in range(1, training.steps + 1):
            margin = 1 - y * (np.bincount(numbers, w[columns] * values, len(rows)) + b)
            error = -2 * share * y * np.maximum(margin, 0)
            slope = np.append(np.bincount(columns, error[numbers] * values, size[0]) + training.decay * w, error.sum())
            mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
            move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            w -= move[:-1]
            b -= move[-1]
        intercepts[machine] = b
    return weights, intercepts


def train(docs: DataFrame, training: Training = Training(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """A model from ``docs``, which must not hold rows that nothing may be learned from; None if none has a language.

    The documents of each language are chosen by hash of id and text; copies count once, rows without an id not at all.
    """
    named = docs.filter(F.col(lang).isNotNull() & F.col(key).isNotNull())
    counts = named.groupBy(F.col(lang).alias("l")).count().orderBy(F.desc("count"), "l").limit(training.languages).collect()
    languages = sorted(r.l for r in counts)
    if not languages:
        return None
    # A threshold on the hash leaves about twice as many as are wanted of each language; the exact cut comes after.
    rows = named.select(F.col(lang).alias("l"), F.col(text).alias("t"), F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("h"))
    share = {r.l: min(1.0, 2 * training.per_language / r["count"]) for r in counts}
    bound = F.create_map(*[F.lit(x) for l in languages for x in (l, min(2**63 - 1, int(share[l] * 2**63)))])
    wanted = F.col("l").isin(languages) & (F.shiftrightunsigned("h", 1) <= F.try_element_at(bound, F.col("l")))
    words = _WORD.pattern

    def windows():
        def choose(batch):
            out, langs, hashes = [], [], []
            for language, body, number in zip(batch["l"], batch["t"], batch["h"]):
                found = re.findall(words, (body or "").lower())
                for at, size in enumerate(training.windows):
                    if found:
                        start = zlib.crc32(f"{number}:{at}".encode()) % max(1, len(found) - size + 1)
                        out.append(" ".join(found[start : start + size]))
                        langs.append(language)
                        hashes.append(number)
            return {"l": langs, "w": out, "h": hashes}

        return choose

    sample = materialized(per_batch(rows.filter(wanted).dropDuplicates(["l", "h"]), ["l", "t", "h"], windows, "l string, w string, h bigint"))
    most = training.per_language * len(training.windows)
    few = sample.withColumn("n", F.row_number().over(_by_hash())).filter(F.col("n") <= most)
    learned = sorted((r.l, r.w) for r in few.select("l", "w").collect())
    vectors = [np.concatenate(list(runs(text, training.buckets))) for _, text in learned]
    labels = np.array([l for l, _ in learned], object)
    languages = sorted(set(labels))
    if not languages:
        return None
    family_of = {l: f for f, members in training.families.items() for l in members}
    named_families: dict[str, list[str]] = {}
    for l in languages:
        named_families.setdefault(family_of.get(l, f"only {l}"), []).append(l)
    families = [named_families[f] for f in sorted(named_families)]
    pairs = [p for f in families for p in combinations(f, 2)]
    targets = [np.where(np.isin(labels, f), 1, -1) for f in families if len(families) > 1]
    targets += [np.where(labels == a, 1, np.where(labels == b, -1, 0)) for a, b in pairs]
    if not targets:
        return Model(languages, families, pairs, np.zeros((training.buckets, 0)), np.zeros(0))
    weights, intercepts = svm(vectors, np.stack(targets, 1), training)
    return Model(languages, families, pairs, weights, intercepts)


def _by_hash():
    from pyspark.sql import Window

    return Window.partitionBy("l").orderBy("h", "w")


class Predictor:
    """A worker's side of the model."""

    def __init__(self, model: Model, buckets: int) -> None:
        self.model, self.buckets = model, buckets

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and how sure that is; a text without a letter has none, with score 0."""
        if not text or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0
        sums, many = np.zeros(self.model.weights.shape[1]), 0
        for part in runs(text, self.buckets):
            sums += self.model.weights[part].sum(0)
            many += len(part)
        return self.decide(sums * (20 / max(1, many)) + self.model.intercepts)

    def decide(self, margins: np.ndarray) -> tuple[str, float]:
        many = len(self.model.families) if len(self.model.families) > 1 else 0
        sure = 1.0
        family = self.model.families[0]
        if many:
            odds = np.exp(2 * (margins[:many] - margins[:many].max()))
            family, sure = self.model.families[int(np.argmax(odds))], float(odds.max() / odds.sum())
        votes = {l: 0.0 for l in family}
        chance = {l: [] for l in family}
        for (a, b), margin in zip(self.model.pairs, margins[many:]):
            if a in votes:
                votes[a if margin > 0 else b] += 1
                first = 1 / (1 + np.exp(-np.clip(2 * margin, -30, 30)))
                chance[a].append(first)
                chance[b].append(1 - first)
        best = max(sorted(votes), key=lambda l: (votes[l], sum(chance[l])))
        return best, float(sure * np.mean(chance[best] or [1.0]))


def predict(df: DataFrame, model: Model | None, training: Training = Training(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score (0 to 1) of every document, from its whole text.

    A null text, or one without a letter, is ``und`` with score 0; so is everything if no language was learned. Ties in
    votes go to the surer, then to the first by name. Repeated rows are judged each, an empty table gives no rows, and
    other columns of the input are not looked at.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        predictor = Predictor(sent.value, training.buckets) if sent.value else None

        def run(batch):
            found = [predictor.predict(t) if predictor else (UNKNOWN, 0.0) for t in batch["t"]]
            return {"id": batch["id"], "lang_pred": [l for l, _ in found], "score": [s for _, s in found]}

        return run

    kind = df.schema[key].dataType.simpleString()
    out = per_batch(df, [df[key].alias("id"), df[text].alias("t")], make, f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", key)
