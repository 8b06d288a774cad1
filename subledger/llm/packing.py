"""Best-fit packing planned on a histogram of lengths.

Best-fit decreasing needs to know how many pieces of each length there are, not which. So the pieces are counted by length
(at most one row per token of capacity reaches the driver), and whole groups of alike sequences are filled at once: the
plan stays within a few entries per length however many pieces there are. A piece then takes the slot that the plan
gives to its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.llm.common import per_batch, with_row_id
from subledger.llm.pretokens import worker_encoder

#: Pieces per rank bucket: one task ranks the pieces of one length in one bucket.
BUCKET_ROWS = 100_000
_ROW, _BUCKET, _RANK, _LENGTH = "_pack_row", "_pack_bucket", "_pack_rank", "_pack_length"


@dataclass(frozen=True)
class Run:
    """Pieces of one length from ``rank`` on: ``each`` of them into every sequence from ``sequence`` on, at ``offset``."""

    rank: int
    sequence: int
    each: int
    offset: int


def plan_best_fit(counts: Mapping[int, int], capacity: int) -> dict[int, list[Run]]:
    """Best-fit decreasing over counts: a piece goes to the fullest sequence that still takes it."""
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> groups of (first sequence, sequences)
    free: list[int] = []  # the keys of room in order
    opened, plan = 0, {}

    def give_back(left: int, first: int, many: int) -> None:
        if left not in room:
            room[left] = []
            bisect.insort(free, left)
        room[left].append((first, many))

    for length in sorted(counts, reverse=True):
        runs, rank, left = plan.setdefault(length, []), 0, counts[length]
        while left:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                space = free[at]
                first, many = room[space].pop()
                if not room[space]:
                    del room[space], free[at]
            else:
                space, first = capacity, opened
                many = -(-left // (capacity // length))
                opened += many
            each = space // length
            full = min(many, left // each)
            if full:
                runs.append(Run(rank, first, each, capacity - space))
                rank, left = rank + full * each, left - full * each
                give_back(space - each * length, first, full)
            if full < many and left:  # fewer are left than one more sequence takes
                runs.append(Run(rank, first + full, left, capacity - space))
                give_back(space - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            if full < many:
                give_back(space, first + full, many - full)
    return plan


def cut(
    df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text", ids: bool = True
) -> DataFrame:
    """The pieces of every document: key, piece (from 0), start, length, ids_crc32, and with ``ids`` the ids themselves, as
    little-endian 32-bit integers.

    A document's ids are those of its text and ``end_id``; only documents longer than ``capacity`` are cut. A null or
    empty text gives the end alone, a very long one all its pieces, a repeated row its pieces again. Other columns of the
    input are not looked at.
    """
    kind = df.schema[key].dataType.simpleString()

    def make():
        encoder, end = worker_encoder(path), np.array([end_id], "<u4").tobytes()

        def run(batch):
            out = {k: [] for k in names}
            for doc, body in zip(batch["id"], batch["t"]):
                found = encoder.encode(body) + end
                for piece, start in enumerate(range(0, len(found) // 4, capacity)):
                    part = found[4 * start : 4 * (start + capacity)]
                    for name, value in zip(names, (doc, piece, start, len(part) // 4, zlib.crc32(part), part)):
                        out[name].append(value)
            return out

        return run

    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if ids else "")
    names = T.StructType.fromDDL(schema).names
    return per_batch(df, [df[key].alias("id"), df[text].alias("t")], make, schema).withColumnRenamed("id", key)


def ranked(rows: DataFrame, length: str) -> DataFrame:
    """Rows with their number, from 0, among those of the same length.

    No task sees all rows of a length: they are dealt to buckets, numbered there, and shifted by the buckets before.
    """
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    dealt = rows.withColumn(_BUCKET, F.pmod(F.xxhash64(_ROW), F.lit(buckets)))
    before = Window.partitionBy(_LENGTH).orderBy("_other").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        dealt.groupBy(F.col(length).alias(_LENGTH), F.col(_BUCKET).alias("_other"))
        .agg(F.count("*").alias("_n"))
        .select(_LENGTH, "_other", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    within = F.row_number().over(Window.partitionBy(length, _BUCKET).orderBy(_ROW)) - 1
    met = (F.col(length) == F.col(_LENGTH)) & (F.col(_BUCKET) == F.col("_other"))
    shifted = dealt.withColumn(_RANK, within).join(shifts, met, "left").withColumn(_RANK, F.col(_RANK) + F.col("_shift"))
    return shifted.drop(_LENGTH, _BUCKET, "_other", "_shift")


def pack(pieces: DataFrame, capacity: int = 4096, length: str = "length") -> DataFrame:
    """``pieces`` with the sequence each goes to and its offset there; sequences are filled from 0 without gaps.

    Columns named sequence_id and offset are replaced. Lengths must be 1 to ``capacity``; rows with null or other lengths
    stay, with null for both. Repeated rows are packed each; an empty table stays empty. The pieces are written once, so
    that ranks do not change when a task is repeated.
    """
    rows = with_row_id(pieces.drop("sequence_id", "offset"), _ROW)
    size = F.col(length)
    counts = rows.filter(size.between(1, capacity)).groupBy(size.cast("int").alias("n")).count().collect()
    plan = rows.sparkSession.sparkContext.broadcast(plan_best_fit({r["n"]: r["count"] for r in counts}, capacity))
    placed = T.StructType([f for f in rows.schema if f.name != _ROW])
    placed = placed.add("sequence_id", T.LongType()).add("offset", T.LongType())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {
            n: np.array([(r.rank, r.sequence, r.each, r.offset) for r in runs], np.int64) for n, runs in plan.value.items()
        }
        for batch in batches:
            at = {n: k for k, n in enumerate(batch.schema.names)}
            kept = [n for n in at if n not in (_ROW, _RANK)]
            sequences, offsets = [], []
            for n, rank in zip(batch.column(at[length]).to_pylist(), batch.column(at[_RANK]).to_pylist()):
                if n not in tables:
                    sequences.append(None)
                    offsets.append(None)
                    continue
                runs = tables[n]
                first, sequence, each, offset = runs[np.searchsorted(runs[:, 0], rank, "right") - 1].tolist()
                sequences.append(sequence + (rank - first) // each)
                offsets.append(offset + (rank - first) % each * n)
            places = [pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())]
            columns = [batch.column(at[n]) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, *places], names=[*kept, "sequence_id", "offset"])

    return ranked(rows, length).mapInArrow(place, placed)
