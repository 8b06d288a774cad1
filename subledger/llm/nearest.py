"""Nearest neighbours by inner product from randomly rotated one-bit codes.

Every vector is scaled to length one, turned by a random rotation and reduced to the signs of its components. With the
length and one more scalar (how well the signs point along the vector) a code gives an unbiased estimate of the inner
product with any query, and a bound on its error. Blocks of codes are searched for blocks of queries: estimate all, keep
the vectors whose upper bound reaches the best lower bounds, and compute those exactly.

Every query starts with a score to beat, the k-th best of a bounded sample, so most blocks return little or nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.common import per_batch, with_row_id
from subledger.session import materialized


@dataclass(frozen=True)
class Settings:
    """``block`` vectors and ``queries`` queries meet in one task. ``sample`` vectors, chosen by hash, give each query its
    score to beat. ``bound`` scales the error bound of an estimate: at 3 about one in a thousand lies outside it.
    """

    k: int = 20
    block: int = 8192
    queries: int = 2048
    sample: int = 2048
    bound: float = 3.0
    seed: int = 11


def rotation(dimension: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every caller."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths, and the inner product of each unit vector with the direction of its signs."""
    lengths = np.linalg.norm(vectors, axis=1)
    turned = (vectors / lengths[:, None]) @ turn
    along = np.abs(turned).sum(1) / np.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), lengths, along


def estimates(
    queries: np.ndarray, bits: np.ndarray, lengths: np.ndarray, along: np.ndarray, turn: np.ndarray, bound: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x codes) and how far each may be off.

    With unit vector o, sign direction s, <s,o> = along: <s,q> / along estimates <o,q>, and what it misses is the part of q
    that s has across o, of size sqrt(1 - along^2) / along in a random direction of the other dimensions.
    """
    dimension = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dimension).astype(np.float32) * 2 - 1
    turned = (queries @ turn).astype(np.float32)
    guess = (turned @ signs.T) * (lengths / along / np.sqrt(dimension)).astype(np.float32)
    spread = np.sqrt(np.maximum(1 - along**2, 0)) / along * lengths / np.sqrt(max(1, dimension - 1))
    off = bound * np.linalg.norm(queries, axis=1)[:, None].astype(np.float32) * spread.astype(np.float32)
    return guess, off


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite numbers."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce(vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def index(df: DataFrame, settings: Settings = Settings(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Every usable vector with its code, written once: row, key, vector (double), bits, length, along.

    Vectors of another dimension than the commonest, and rows without a key, take no part, like unusable vectors. Repeated
    rows are vectors of their own, an empty table gives an empty index; other columns, whatever their names, are left out.
    """
    plain = F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).alias("key"), plain.alias("vector")).filter(usable(F.col("vector")) & F.col("key").isNotNull())
    rows = with_row_id(rows.withColumn("d", F.size("vector")), "row")
    common = rows.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    dimension = common["d"] if common else 1

    def make():
        turn = rotation(dimension, settings.seed)

        def run(batch):
            vectors = np.array(batch["vector"], float).reshape(-1, dimension)
            bits, lengths, along = encode(vectors, turn)
            return {**batch, "bits": [b.tobytes() for b in bits], "length": lengths, "along": along}

        return run

    kind = df.schema[key].dataType.simpleString()
    schema = f"row bigint, key {kind}, vector array<double>, bits binary, length double, along double"
    return materialized(per_batch(rows.filter(F.col("d") == dimension), ["row", "key", "vector"], make, schema))


def _exact(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row by row in double precision, so that equal vectors get equal scores."""
    return np.einsum("qd,nd->qn", queries, vectors, optimize=False)


def search(codes: DataFrame, is_query: Column, settings: Settings = Settings(), key: str = "vec_id") -> DataFrame:
    """For each row of an ``index`` that ``is_query``, its nearest others: query_id, rank, key, score.

    The score is the inner product of the vectors as given, in double precision, ties going to the smaller key. All others
    are returned if there are fewer than k. Rows with equal keys are told apart: a row is never its own neighbour, but one
    that repeats its key may be. Of equal vectors a block considers only as many as could be returned, the smallest keys.
    """
    k, spark = settings.k, codes.sparkSession
    some = codes.orderBy(F.xxhash64("row"), "row").limit(settings.sample).select("row", "vector").collect()
    sample = spark.sparkContext.broadcast(([r.row for r in some], np.array([r.vector for r in some], float)))
    to_queries = codes.filter(is_query).select("row", "key", "vector")

    def floors():
        rows, vectors = sample.value

        def run(batch):
            scores = _exact(np.array(batch["vector"], float), vectors)
            scores[np.array(batch["row"])[:, None] == np.array(rows)[None, :]] = -np.inf
            beat = np.sort(scores, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(scores), -np.inf)
            return {**batch, "floor": beat}

        return run

    kind = codes.schema["key"].dataType.simpleString()
    queries = materialized(per_batch(to_queries, ["row", "key", "vector"], floors, f"row bigint, key {kind}, vector array<double>, floor double"))
    blocks = max(1, -(-codes.count() // settings.block))
    parts = max(1, -(-queries.count() // settings.queries))
    dealt = lambda of: F.pmod(F.xxhash64("row"), F.lit(of)).cast("int")
    # Every block of vectors meets every block of queries in a task of its own, whose size does not grow.
    left = queries.withColumn("part", dealt(parts)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = codes.withColumn("block", dealt(blocks)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def meet(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_row": [], "query_id": [], "key": [], "score": []})
        if not len(asked) or not len(stored):
            return empty
        q, v = np.array(asked["vector"].tolist(), float), np.array(stored["vector"].tolist(), float)
        keys, rows = stored["key"].to_numpy(), stored["row"].to_numpy()
        order = np.lexsort((rows, keys))
        v, keys, rows, stored = v[order], keys[order], rows[order], stored.iloc[order]
        same = np.unique(v.view([("", v.dtype)] * v.shape[1]).ravel(), return_inverse=True)[1].ravel()
        by_vector = np.argsort(same, kind="stable")
        first = np.r_[True, same[by_vector][1:] != same[by_vector][:-1]]
        nth = np.arange(len(same)) - np.maximum.accumulate(np.where(first, np.arange(len(same)), 0))
        use = np.sort(by_vector[nth <= k])  # k others of one vector, and the query itself
        v, keys, rows = v[use], keys[use], rows[use]
        bits = np.frombuffer(b"".join(stored["bits"].iloc[use]), np.uint8).reshape(len(use), -1)
        guess, off = estimates(q, bits, stored["length"].to_numpy()[use], stored["along"].to_numpy()[use], rotation(v.shape[1], settings.seed), settings.bound)
        itself = asked["row"].to_numpy()[:, None] == rows[None, :]
        low = np.where(itself, -np.inf, guess - off)
        floor = asked["floor"].to_numpy().astype(float)
        if low.shape[1] > k:
            floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
        wanted = (guess + off >= floor[:, None]) & ~itself
        out = []
        for at in np.flatnonzero(wanted.any(1)):
            near = np.flatnonzero(wanted[at])
            scores = _exact(q[at : at + 1], v[near])[0]
            best = np.lexsort((keys[near], -scores))[:k]
            best = best[scores[best] >= asked["floor"].iloc[at]]
            out.append(pd.DataFrame({"query_row": asked["row"].iloc[at], "query_id": asked["key"].iloc[at], "key": keys[near][best], "score": scores[best]}))
        return pd.concat(out) if out else empty

    met = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(
        meet, f"query_row bigint, query_id {kind}, key {kind}, score double"
    )
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "key"))
    nearest = met.withColumn("rank", rank).filter(F.col("rank") <= k)
    return nearest.select("query_id", "rank", F.col("key").alias(key), "score")
