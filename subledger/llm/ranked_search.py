"""Ranked lexical search: term at a time with a limit on accumulators.

Documents are dealt as they lie; nothing but counts and best results leaves a task. A task takes a block of documents after
the other, turns it to postings by term, and scores it for each item: the rarest terms first, adding what a term gives to
the accumulators of the documents that hold it. As soon as all terms still to come together cannot lift a new document to
the score of the k-th best so far, no more accumulators are made, and the others are brought to their exact scores. The k-th
best so far is that of the block or of the blocks before it, whichever is higher, so later blocks make few accumulators.
No document that could be among the best is left out, so results are exact.

Texts are read once: their counts of the items' terms are written, and the counts over the corpus and the scores both come
from those.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.common import per_batch, with_row_id
from subledger.session import materialized

#: Runs of digits, letters and anything beyond ASCII, in UTF-8 whose A to Z are lower case already.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Items are searched in blocks of about this many code points, which bounds what is broadcast.
BLOCK_CHARS = 4_000_000
#: Documents, and counts of terms, that a task scores at a time.
BLOCK_DOCUMENTS, BLOCK_POSTINGS = 8192, 2_000_000
#: Parts that an item's results are cut into before the last ranking.
PARTS = 32


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order; bytes.lower() turns A to Z only."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


@dataclass
class Wanted:
    """Items of one block: numbers, and of each its terms (numbers) with how often it holds them."""

    numbers: list[int]
    terms: list[np.ndarray]
    times: list[np.ndarray]
    vocabulary: dict[bytes, int]


@dataclass
class Corpus:
    """``documents`` with a term, ``length`` of all of them in terms, and of each wanted term how many documents hold it."""

    documents: int
    length: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        up = 2 * self.documents + 2
        return np.array([math.floor(1000 * math.log(up / (2 * held + 1))) for held in self.holding.tolist()], np.int64)

    def damping(self, lengths: np.ndarray) -> np.ndarray:
        """m of documents of these lengths; beyond 64 bits in Python's integers."""
        if len(lengths) and 25 * int(lengths.max()) * self.documents >= 2**63:
            return np.array([75 + 25 * n * self.documents // self.length for n in lengths.tolist()], np.int64)
        return 75 + 25 * lengths * self.documents // self.length


def rank(
    docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text"
) -> DataFrame:
    """The ``k`` best documents for each item: item, rank (from 1), key, score (above 0), ties by ascending key, null last.

    Null and empty texts and items have no terms, so no results. Whole texts are read however long. Repeated documents and
    items are ranked each; with an empty table of either there are no rows. Other columns of both are not looked at.
    """
    asked = with_row_id(items.select(F.col(item).alias("_id"), F.col(query).alias("_q")), "_item")
    size = asked.agg(F.coalesce(F.sum(F.length("_q")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_CHARS))
    found = [
        _search(docs.select(F.col(key).alias("id"), F.col(text).alias("t")), asked.filter(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == n), k)
        for n in range(blocks)
    ]
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    best = _best(_best(best, ["_item", F.pmod(F.xxhash64("id"), F.lit(PARTS))], k), ["_item"], k)
    named = best.join(asked.select("_item", "_id"), "_item")
    return named.select(F.col("_id").alias(item), F.col("_rank").alias("rank"), F.col("id").alias(key), "score")


def _best(rows: DataFrame, group: Sequence[str | Column], k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)


def _search(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    wanted = _wanted([(r["_item"], r["_q"]) for r in asked.select("_item", "_q").collect()])
    counted = _counted(docs, wanted.vocabulary)
    corpus = _corpus(counted, len(wanted.vocabulary))
    sent = spark.sparkContext.broadcast((wanted.numbers, wanted.terms, wanted.times, corpus))
    kind = docs.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, item_terms, item_times, corpus = sent.value
        search = Search(item_terms, item_times, corpus, k)
        waiting, postings, id_type = [], 0, None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                waiting.append(part)
                postings += sum(map(len, part.column(2).to_pylist())) // 4
                if sum(p.num_rows for p in waiting) >= BLOCK_DOCUMENTS or postings >= BLOCK_POSTINGS:
                    search.add(waiting)
                    waiting, postings = [], 0
        if waiting:
            search.add(waiting)
        for number, (scores, ids) in zip(numbers, search.best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(scores), pa.int64()), pa.array(ids, id_type), pa.array(scores, pa.int64())],
                    names=["_item", "id", "score"],
                )

    return counted.mapInArrow(run, f"_item bigint, id {kind.simpleString()}, score bigint")


def _wanted(rows: list[tuple[int, str | None]]) -> Wanted:
    vocabulary: dict[bytes, int] = {}
    numbers, own, times = [], [], []
    for number, text in sorted(rows):
        tally = Counter(terms(text))
        numbers.append(number)
        own.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in tally], np.int64))
        times.append(np.array(list(tally.values()), np.int64))
    return Wanted(numbers, own, times, vocabulary)


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents with a term, written once: id, number of terms, and the wanted ones among them with their counts, as 32-bit
    integers."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        number = sent.value.get

        def run(batch):
            out = {"id": [], "n": [], "terms": [], "times": []}
            for doc, text in zip(batch["id"], batch["t"]):
                if not (found := terms(text)):
                    continue
                own, times = np.unique(np.array([n for n in map(number, found) if n is not None], np.uint32), return_counts=True)
                for name, value in zip(out, (doc, len(found), own.tobytes(), times.astype(np.uint32).tobytes())):
                    out[name].append(value)
            return out

        return run

    kind = docs.schema["id"].dataType.simpleString()
    return materialized(per_batch(docs, ["id", "t"], make, f"id {kind}, n bigint, terms binary, times binary"))


def _corpus(counted: DataFrame, size: int) -> Corpus:
    """Counts over all documents. A task sends one row per wanted term at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32), minlength=size)
        where = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(held[where])], names=["term", "held"])

    rows = counted.select("terms").mapInArrow(count, "term bigint, held bigint").groupBy("term").agg(F.sum("held").alias("held")).collect()
    holding = np.zeros(size, np.int64)
    for r in rows:
        holding[r["term"]] = r["held"]
    totals = counted.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    return Corpus(totals["n"], totals["l"], holding)


class Search:
    """The best documents of a task, block by block."""

    def __init__(self, item_terms: list[np.ndarray], item_times: list[np.ndarray], corpus: Corpus, k: int) -> None:
        self.corpus, self.k = corpus, k
        weights = corpus.weights()
        self.items = []
        for own, times in zip(item_terms, item_times):
            order = np.argsort(corpus.holding[own], kind="stable")  # rarest first
            own, gives = own[order], (weights[own] * times)[order]
            self.items.append((own[gives > 0], gives[gives > 0]))
        self.best: list[tuple[np.ndarray, list]] = [(np.empty(0, np.int64), [])] * len(self.items)
        self.made = 0  # accumulators, for tests

    def add(self, parts: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(parts)
        ids, lengths = table.column("id").to_pylist(), table.column("n").to_numpy()
        own = table.column("terms").to_pylist()
        term = np.frombuffer(b"".join(own), np.uint32)
        times = np.frombuffer(b"".join(table.column("times").to_pylist()), np.uint32).astype(np.int64)
        place = np.empty(len(ids), np.int64)
        place[sorted(range(len(ids)), key=lambda n: (ids[n] is None, ids[n] if ids[n] is not None else 0))] = np.arange(len(ids))
        doc = np.repeat(np.arange(len(ids)), [len(raw) // 4 for raw in own])
        part = 10**9 * times // (1000 * times + 12 * self.corpus.damping(lengths)[doc])
        order = np.argsort(term, kind="stable")
        term, doc, part = term[order], doc[order], part[order]
        present, first = np.unique(term, return_index=True)
        if not len(present):
            return
        most, ends = np.maximum.reduceat(part, first), np.append(first[1:], len(term))
        slot = np.full(len(self.corpus.holding), -1)
        slot[present] = np.arange(len(present))
        for number, (wanted, gives) in enumerate(self.items):
            at = slot[wanted]
            at, gives = at[at >= 0], gives[at >= 0]
            if len(at):
                postings = [(doc[a:b], part[a:b]) for a, b in zip(first[at], ends[at])]
                self._keep(number, self._score(number, postings, gives, gives * most[at], len(ids)), ids, place)

    def _score(self, number: int, postings: list, gives: np.ndarray, most: np.ndarray, documents: int) -> np.ndarray:
        """Scores of the block's documents; 0 for those that cannot be among the best."""
        scores, have = np.zeros(documents, np.int64), np.zeros(documents, bool)
        to_come = np.cumsum(most[::-1])[::-1]
        least, many, creating = self._least(number), 0, True
        for (doc, part), give, rest in zip(postings, gives, to_come):
            if creating and many >= self.k:
                least = max(least, int(np.partition(scores, documents - self.k)[documents - self.k]))
            if creating and rest < least:  # a new document would stay below: it may not even tie
                creating = False
            if creating:
                many += len(doc) - int(np.count_nonzero(have[doc]))
                have[doc] = True
            else:
                old = have[doc]
                doc, part = doc[old], part[old]
            scores[doc] += give * part
        self.made += many
        return scores

    def _least(self, number: int) -> int:
        """The score of the k-th best of the blocks before; 0 if there are fewer."""
        scores, _ = self.best[number]
        return int(scores[-1]) if len(scores) == self.k else 0

    def _keep(self, number: int, scores: np.ndarray, ids: list, place: np.ndarray) -> None:
        where = np.flatnonzero((scores > 0) & (scores >= self._least(number)))
        where = where[np.lexsort((place[where], -scores[where]))][: self.k]
        if not len(where):
            return
        known, names = self.best[number]
        merged = sorted(
            [*zip(known.tolist(), names), *zip(scores[where].tolist(), [ids[n] for n in where])],
            key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0),
        )[: self.k]
        self.best[number] = np.array([s for s, _ in merged], np.int64), [n for _, n in merged]
