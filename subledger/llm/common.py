"""What several operators share: words, folds, row ids, and functions over Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.session import materialized

#: A word: a run of anything but space and the five control characters that end or separate lines.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Folds of a table, and the one no model may learn from.
FOLDS, HELD_OUT = 4, 2

#: Rows handed to a function at once: bounds a Python worker's memory when texts are very long.
BATCH_ROWS = 500

Batch = dict[str, list]


def words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 2 by 4; never null (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def per_batch(
    df: DataFrame, columns: Sequence[str | Column], make: Callable[[], Callable[[Batch], Mapping[str, Sequence]]], schema: str
) -> DataFrame:
    """Rows that a function computes from ``columns``, batch by batch.

    ``make`` runs once per task and returns the function, so that caches and models live as long as the task. The
    function gets the columns as lists and returns those of ``schema``, of any common length.
    """
    spark = df.sparkSession
    names = T.StructType.fromDDL(schema).names
    arrow = _arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                out = function({k: v.to_pylist() for k, v in zip(batch.schema.names, batch.slice(start, BATCH_ROWS))})
                yield pa.RecordBatch.from_arrays([pa.array(out[n], arrow.field(n).type) for n in names], schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


def per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
    function: Callable[[dict[str, np.ndarray], np.ndarray], Mapping[str, np.ndarray]], schema: str,
) -> DataFrame:
    """Rows that a function computes from whole groups, many small groups at once.

    The function gets ``columns`` as arrays, ordered by group and ``order``, and the number of each row's group. Groups
    must be bounded: a task holds one of them and a batch of rows.
    """
    names = T.StructType.fromDDL(schema).names
    arrow = _arrow_schema(df.sparkSession, schema)

    def values(column: pa.ChunkedArray) -> np.ndarray:
        return np.array(column.to_pylist(), object) if pa.types.is_binary(column.type) else column.to_numpy()

    def compute(table: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        out = function({c: values(table.column(c)) for c in columns}, group)
        return pa.RecordBatch.from_arrays([pa.array(out[n], arrow.field(n).type) for n in names], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            table = pa.Table.from_batches(waiting)
            group = _group_numbers(table, keys)
            last = int(np.searchsorted(group, group[-1]))  # the last group may go on in the next batch
            if last:
                yield compute(table.slice(0, last), group[:last])
                waiting = table.slice(last).to_batches()
        if waiting:
            table = pa.Table.from_batches(waiting)
            yield compute(table, _group_numbers(table, keys))

    used = list(dict.fromkeys([*keys, *order, *columns]))
    return df.select(*used).repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _group_numbers(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    changed = np.zeros(table.num_rows, bool)
    for key in keys:
        values = table.column(key).to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.cumsum(changed)


def keep_rows(df: DataFrame, columns: Sequence[str], make: Callable[[], Callable[[Batch], Sequence[bool]]]) -> DataFrame:
    """The rows of ``df``, all columns as they are, for which the function over ``columns`` says true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                kept = function({c: part.column(part.schema.names.index(c)).to_pylist() for c in columns})
                yield part.filter(pa.array(kept, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once with a number per row: equal rows differ, and every later read agrees on the numbers."""
    return materialized(df.withColumn(name, F.monotonically_increasing_id()))
