"""N-gram Jaccard join by chosen paths.

Texts are sets of hashed word n-grams. A run grows a tree: at each node a set keeps the tokens that a hash, seeded by the
node, puts below 1 / (threshold x size), and goes down once for each. Two sets meet below a node if they sampled the same
shared token; alike sets share enough tokens to meet at least once on average at any depth, others drift apart. Nodes with
few sets are compared directly, larger ones go one level deeper, and runs are repeated until a pair at the threshold is
met with the target recall.

Meeting sets are compared by bit sketches, which leaves groups of likely links. Within a group every pair is then decided
by the exact similarity of the whole sets, block by block, so links are counted without being written out, and pairs that
the paths missed are found if both belong to the group.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import WORD, per_batch, per_group, with_row_id, words
from subledger.session import materialized

#: Odd multipliers of the public splitmix64 generator.
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@dataclass(frozen=True)
class Settings:
    """Nodes of more than ``small`` sets are split, to ``depth`` levels. Nodes are compared in blocks of ``block`` sketches
    and groups in blocks of ``exact_block`` sets, so neither is limited in size. ``sketch`` bits estimate a similarity;
    pairs estimated up to ``margin`` below the threshold are decided exactly.
    """

    words: int = 5
    threshold: float = 0.8
    recall: float = 0.9999
    small: int = 2048
    depth: int = 3
    block: int = 2048
    exact_block: int = 512
    sketch: int = 512
    margin: float = 0.12
    seed: int = 5

    def meeting(self) -> float:
        """Chance that a run brings a pair at the threshold to the same node of the deepest level.

        The tokens that both sample are at least Poisson of mean 1, so the chance of one that leads on is
        1 - exp(-chance below it).
        """
        chance = 1.0
        for _ in range(self.depth):
            chance = 1 - math.exp(-chance)
        return chance

    def runs(self) -> int:
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.meeting()))


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


#: Times that a sketch deals tokens to buckets, and what sets the deals apart.
_DEALS = 12
_SALTS = _scramble(np.arange(1, _DEALS + 1, dtype=np.uint64) * _STEP)


class _WordIds(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:  # bounds a worker's memory
            self.clear()
        raw = word.encode("utf-8", "surrogatepass")
        found = self[word] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
        return found


class Shingler:
    """Token sets of texts: 64-bit hashes of word n-grams. A shorter text is one token, a text without words none."""

    def __init__(self, width: int) -> None:
        self.width, self.ids = width, _WordIds()

    def __call__(self, text: str | None) -> np.ndarray:
        found = words(text)
        if not found:
            return np.empty(0, np.uint64)
        ids = _scramble(np.fromiter(map(self.ids.__getitem__, found), np.uint64, len(found)))
        width = min(self.width, len(ids))
        out = ids[: len(ids) - width + 1] + np.uint64(width)
        for at in range(1, width):
            out = out * _MIX[0] + ids[at : at + len(out)]
        return np.unique(_scramble(out))


def paths(tokens: np.ndarray, settings: Settings) -> list[list[int]]:
    """Node numbers on all levels of all runs: for each leaf its nodes from the first level down.

    Where a set samples nothing its path ends, which the chance of meeting allows for.
    """
    if not len(tokens):
        return []
    below = np.uint64(min(2**64 - 1, int(2**64 / (settings.threshold * len(tokens)))))
    nodes = _scramble(np.arange(settings.runs(), dtype=np.uint64) + np.uint64(settings.seed << 32))
    trail = np.empty((len(nodes), 0), np.uint64)
    done: list[list[int]] = []
    for _ in range(settings.depth):
        picked_node, picked_token = [], []
        step = max(1, 2_000_000 // len(tokens))  # bounds the table of nodes by tokens
        for at in range(0, len(nodes), step):
            hit = (nodes[at : at + step, None] ^ tokens[None, :]) * _STEP < below
            n, t = np.nonzero(hit)
            picked_node.append(n + at)
            picked_token.append(t)
        n, t = np.concatenate(picked_node), np.concatenate(picked_token)
        if trail.shape[1]:
            ended = np.bincount(n, minlength=len(nodes)) == 0
            done += trail[ended].view(np.int64).tolist()
        nodes = _scramble(nodes[n] * np.uint64(3) + tokens[t])
        trail = np.concatenate([trail[n], nodes[:, None]], 1)
    return done + trail.view(np.int64).tolist()


def sketch(tokens: np.ndarray, settings: Settings) -> bytes:
    """One bit of the minimum of each of ``sketch`` hash functions: equal bits are 1/2 + similarity/2.

    The functions come from dealing the tokens to buckets, again and again with other hashes, until each bucket has been
    reached; it keeps the minimum of the first deal that did. Buckets that a small set never reaches take a hash function
    of their own over all tokens.
    """
    size, none = settings.sketch, np.iinfo(np.uint64).max
    shift = np.uint64(64 - (size - 1).bit_length())
    least = np.full(size, none, np.uint64)
    for deal in range(_DEALS):
        dealt = (tokens ^ _SALTS[deal]) * _STEP
        now = np.full(size, none, np.uint64)
        np.minimum.at(now, dealt >> shift, dealt * _MIX[1])
        empty = least == none
        least[empty] = now[empty]
        if (least != none).all():
            break
    empty = np.flatnonzero(least == none)
    if len(empty):
        least[empty] = _scramble(tokens[None, :] ^ _scramble(empty.astype(np.uint64) + _SALTS[0])[:, None]).min(1)
    return np.packbits((_scramble(least) & np.uint64(1)).astype(bool)).tobytes()


def first_of_group(many: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows 0 to ``many`` - 1 the smallest row that the links a-b join them to."""
    label = np.arange(many)
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def likely(group: np.ndarray, sizes: np.ndarray, bits: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of the same group whose sizes allow the threshold and whose sketches come near it.

    Rows are ordered by group and size: row by row distance, all groups at once, until no pair is left.
    """
    most_unequal = settings.sketch * (1 - settings.threshold + settings.margin) / 2
    at, left, right = np.arange(len(group)), [], []
    for step in range(1, len(group)):
        at = at[at + step < len(group)]
        at = at[(group[at] == group[at + step]) & (sizes[at + step] * settings.threshold <= sizes[at] + 1e-9)]
        if not len(at):
            break
        unequal = np.bitwise_count(bits[at] ^ bits[at + step]).sum(1, dtype=np.int64)
        met = at[unequal <= most_unequal]
        left.append(met)
        right.append(met + step)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def in_block_pairs(rows: DataFrame, key: str, order: str, block: int) -> DataFrame:
    """Rows of each ``key`` dealt so that every pair meets: keys of up to ``block`` rows once; larger ones in blocks, each
    pair of which has a task of its own (``_first`` <= ``_second``). Rows are repeated once per block, never per pair.
    """
    counts = rows.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_rows"))
    counts = counts.filter("_rows > 1").withColumn("_blocks", F.ceil(F.col("_rows") / block).cast("int"))
    dealt = rows.join(counts, F.col(key) == F.col("_k")).drop("_k", "_rows")
    own = F.when(F.col("_blocks") > 1, F.pmod(F.xxhash64(order), F.col("_blocks")).cast("int")).otherwise(F.lit(0))
    return (
        dealt.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("_first", F.least("_own", "_other"))
        .withColumn("_second", F.greatest("_own", "_other"))
        .drop("_other", "_blocks")
    )


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node joined to it) for every node of ``links`` (a, b).

    Alternating star contraction: each turn ties every node to the smallest of its neighbours, first those above it, then
    those below. Links never grow in number beyond the nodes' own, and turns grow with the logarithm of the longest
    chain. Each turn is written, so none is computed twice.
    """
    edges = materialized(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("x"), "m", "a")
        turned = small.select(F.col("x").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        after = materialized(turned.filter("a != b").distinct())
        # Settled when nothing is above anything but its root: no node is both tied and tied to.
        moving = not after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()
        edges = after
        if not moving and edges.groupBy("a").count().filter("count > 1").isEmpty():
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _steps(level: int) -> Column:
    """The different nodes of a set's paths at a level, each with the node above it; a node has one way down to it."""
    reached = F.filter("paths", lambda p: F.size(p) >= level)
    above = lambda p: F.get(p, F.lit(level - 2)) if level > 1 else F.lit(None).cast("bigint")
    step = lambda p: F.struct(above(p).alias("above"), F.get(p, F.lit(level - 1)).alias("node"))
    return F.array_distinct(F.transform(reached, step))


def _likely_links(sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between set numbers that join at least the pairs the paths bring together and the sketches allow."""
    large, found = None, []
    for level in range(1, settings.depth + 1):
        here = sets.select("set", F.explode(_steps(level)).alias("step")).select("set", "step.*")
        if large is not None:
            here = here.join(large, F.col("above") == F.col("_node"), "left_semi")
        here = materialized(here.select("node", "set"))
        counts = here.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
        leaves = counts.filter(F.col("n") <= settings.small) if level < settings.depth else counts
        together = here.join(leaves.select("node"), "node", "left_semi").join(sets.select("set", "size", "sketch"), "set")
        found.append(_compared(together, settings))
        large = materialized(counts.filter(F.col("n") > settings.small).select(F.col("node").alias("_node")))
        if large.isEmpty():
            break
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links.distinct()


def _compared(rows: DataFrame, settings: Settings) -> DataFrame:
    """One link per set of a node, at most, to the first of those that its likely pairs join it to."""
    dealt = in_block_pairs(rows, "node", "set", settings.block)

    def compare(columns: dict[str, np.ndarray], group: np.ndarray) -> dict[str, np.ndarray]:
        bits = np.frombuffer(b"".join(columns["sketch"]), np.uint64).reshape(len(group), -1)
        first = first_of_group(len(group), *likely(group, columns["size"], bits, settings))
        tied = np.flatnonzero(first != np.arange(len(group)))
        return {"a": columns["set"][first[tied]], "b": columns["set"][tied]}

    return per_group(dealt, ["node", "_first", "_second"], ["size", "set"], ["set", "size", "sketch"], compare, "a bigint, b bigint")


def overlaps(left: Sequence[np.ndarray], right: Sequence[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs, by products of the sets' indicator rows over their common tokens."""
    common = np.intersect1d(np.concatenate(left), np.concatenate(right)) if left and right else np.empty(0)
    out = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    columns = [[np.searchsorted(common, s[np.isin(s, common, assume_unique=True)]) for s in side] for side in (left, right)]
    for at in range(0, len(common), width):
        dense = []
        for side in columns:
            table = np.zeros((len(side), width), np.float32)
            for n, where in enumerate(side):
                table[n, where[np.searchsorted(where, at) : np.searchsorted(where, at + width)] - at] = 1
            dense.append(table)
        out += dense[0] @ dense[1].T
    return out


def _decided(members: DataFrame, settings: Settings) -> DataFrame:
    """Per group and block pair: each set's number of exact links, and the first set that these join it to."""
    dealt = in_block_pairs(members, "root", "set", settings.exact_block)

    def decide(columns: dict[str, np.ndarray], group: np.ndarray) -> dict[str, np.ndarray]:
        links, tied = np.zeros(len(group), np.int64), np.arange(len(group))
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        for low, high in zip(starts, [*starts[1:], len(group)]):
            tokens = [np.frombuffer(t, np.uint64) for t in columns["tokens"][low:high]]
            own = columns["_own"][low:high]
            left, right = np.flatnonzero(own == columns["_first"][low]), np.flatnonzero(own == columns["_second"][low])
            both = overlaps([tokens[n] for n in left], [tokens[n] for n in right])
            sizes = np.array([len(t) for t in tokens])
            union = sizes[left][:, None] + sizes[right][None, :] - both
            linked = both >= settings.threshold * union - 1e-6
            if columns["_first"][low] == columns["_second"][low]:
                linked &= left[:, None] < right[None, :]
            a, b = np.nonzero(linked)
            a, b = left[a], right[b]
            links[low:high] = np.bincount(a, minlength=high - low) + np.bincount(b, minlength=high - low)
            tied[low:high] = low + first_of_group(high - low, a, b)
        return {"set": columns["set"], "links": links, "tied": columns["set"][tied]}

    used = ["set", "tokens", "_own", "_first", "_second"]
    return per_group(dealt, ["root", "_first", "_second"], ["set"], used, decide, "set bigint, links bigint, tied bigint")


def _digest(text: Column) -> Column:
    """A strong digest of the text; null if it has no words."""
    return F.when(F.regexp_like(text, F.lit(WORD.pattern)), F.unhex(F.sha2(text, 256)))


def token_sets(docs: DataFrame, settings: Settings) -> DataFrame:
    """The different texts of ``docs`` (digest, text), numbered, each with size, sketch and paths of its token set.

    Copies are merged before anything is computed from them; texts are not written again.
    """
    once = docs.filter("digest is not null").groupBy("digest").agg(F.first("text").alias("text"))

    def make():
        shingle = Shingler(settings.words)

        def run(batch):
            sets = [shingle(t) for t in batch["text"]]
            return {
                "digest": batch["digest"], "size": [len(s) for s in sets],
                "sketch": [sketch(s, settings) for s in sets], "paths": [paths(s, settings) for s in sets],
            }

        return run

    schema = "digest binary, size int, sketch binary, paths array<array<bigint>>"
    return with_row_id(per_batch(once, ["digest", "text"], make, schema), "set")


def _members(docs: DataFrame, sets: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """The token sets of those texts that have a likely link, with their group."""
    named = sets.select("set", "digest").join(groups, F.col("set") == F.col("node")).select("set", "digest", "root")
    texts = docs.join(named, "digest").groupBy("set", "root").agg(F.first("text").alias("text"))

    def make():
        shingle = Shingler(settings.words)
        return lambda batch: {**batch, "tokens": [shingle(t).tobytes() for t in batch.pop("text")]}

    return per_batch(texts, ["set", "root", "text"], make, "set bigint, root bigint, tokens binary")


def join(df: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, class_id, n_links, n_copies.

    Documents are linked if the Jaccard similarity of their sets of word n-grams reaches the threshold; a class is what
    links connect, copies included. ``class_id`` is the same number for all of a class and tells nothing else. ``n_links``
    counts the other texts that a document's is linked to, ``n_copies`` the other rows with the very same text. Texts of
    fewer words than n are one token; texts without words, null ones included, have no class (null) and no links.
    Repeated rows are copies of each other. An empty table gives no rows; other columns are not looked at. Very long texts
    are read whole: a task holds the token set of one of them.
    """
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"), _digest(F.col(text)).alias("digest"))
    sets = token_sets(docs.select("digest", "text"), settings)
    groups = components(_likely_links(sets, settings))
    decided = materialized(_decided(_members(docs.select("digest", "text"), sets, groups, settings), settings))
    links = decided.groupBy("set").agg(F.sum("links").alias("n_links"))
    classes = components(decided.select(F.col("set").alias("a"), F.col("tied").alias("b")))
    copies = docs.groupBy("digest").agg((F.count("*") - 1).alias("n_copies"))
    described = (
        sets.select("set", "digest")
        .join(links, "set", "left")
        .join(classes.withColumnRenamed("node", "set"), "set", "left")
        .join(copies, "digest")
        .select("digest", F.coalesce("root", "set").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    )
    out = docs.select("id", "digest").join(described, "digest", "left")
    return out.select(F.col("id").alias(key), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(0)).alias("n_copies"))


def keep_one(df: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns unchanged, less all but one of each class: the one with the smallest key stays (a null
    key is the last to stay). Documents without words, null ones included, all stay. Of repeated rows one stays, an empty table
    stays empty; columns may have any name but ``_join_row``.
    """
    rows = with_row_id(df, "_join_row")
    classes = join(rows.select("_join_row", text), settings, "_join_row", text).filter("class_id is not null")
    named = materialized(rows.select("_join_row", F.col(key).alias("_key")).join(classes.select("_join_row", "class_id"), "_join_row"))
    first = named.groupBy("class_id").agg(F.min(F.struct(F.col("_key").isNull(), "_key", "_join_row")).alias("_first"))
    others = named.join(first, "class_id").filter(F.col("_first._join_row") != F.col("_join_row"))
    return rows.join(others.select("_join_row"), "_join_row", "left_anti").drop("_join_row")
