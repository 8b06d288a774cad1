"""Literal raw rows: name the columns that matter, the others are null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from subledger.sources import FrameSource, RAW_TABLES, raw_schema

SYSTEM = {table: system for system, tables in RAW_TABLES.items() for table in tables}


def raw(spark: SparkSession, table: str, *records: dict) -> DataFrame:
    schema = raw_schema(SYSTEM[table], table)
    unknown = {k for r in records for k in r} - set(schema.names)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in records], schema)


def source(spark: SparkSession, **tables: list[dict]) -> FrameSource:
    return FrameSource(spark, {t: raw(spark, t, *tables.get(t, [])) for t in SYSTEM})
