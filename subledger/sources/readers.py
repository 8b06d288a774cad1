"""Where the raw tables come from. Schemas are always given, never inferred."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.sources.schemas import raw_schema


class Source(Protocol):
    spark: SparkSession

    def read(self, system: str, table: str) -> DataFrame: ...


class CsvSource:
    """One headed CSV file or folder per table, ``<root>/<table>.csv``. Blank fields are null; bad rows fail the read."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def read(self, system: str, table: str) -> DataFrame:
        return self.spark.read.csv(
            f"{self.root}/{table}.csv", schema=raw_schema(system, table), header=True, enforceSchema=False,
            escape='"', nullValue="", emptyValue="", mode="FAILFAST",
        )


class ParquetSource:
    """One Parquet folder per table, ``<root>/<table>``: the form to use at scale."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def read(self, system: str, table: str) -> DataFrame:
        return self.spark.read.schema(raw_schema(system, table)).parquet(f"{self.root}/{table}")


class CatalogSource:
    """Tables of the session catalog, ``<database>.<table>``, brought to the declared types."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def read(self, system: str, table: str) -> DataFrame:
        df = self.spark.table(f"{self.database}.{table}")
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in raw_schema(system, table)])


class FrameSource:
    """DataFrames already at hand, by table name."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame]):
        self.spark, self.frames = spark, frames

    def read(self, system: str, table: str) -> DataFrame:
        return self.frames[table]
