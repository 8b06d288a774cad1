"""Write the tables: views for staging, tables for core and reporting, each replaced as a whole."""

from __future__ import annotations

import uuid
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.plans.project import CORE, INTERMEDIATE, REPORTING, STAGING, Project
from subledger.sources import RAW_TABLES, Source

# Month columns the facts are partitioned by, so that a report on some months reads only those.
PARTITIONS = {"fct_orders": "order_month", "fct_charges": "charge_month"}

# Tables with two readers each, behind a wide shuffle: written once rather than computed twice, and later readers scan only
# the columns that they use.
SHARED = ["stg_shopify__orders", "stg_shopify__order_line_items", "int_orders__enriched"]


class Sink(Protocol):
    def write(self, df: DataFrame, layer: str, name: str, partition: str | None) -> DataFrame: ...


def _laid_out(df: DataFrame, partition: str | None) -> DataFrame:
    """Gather each month in as few files as its size asks for; adaptive execution splits large months."""
    return df.hint("rebalance", partition) if partition else df


class ParquetSink:
    """``<root>/<layer>/<name>``; ``root`` has to be a folder every executor can write to.

    Plain folders cannot be switched in one step: a run replaces tables in place, so readers that must not see a rebuild
    in progress take a ``VersionedSink``, or a ``CatalogSink`` with a format that commits.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def write(self, df: DataFrame, layer: str, name: str, partition: str | None) -> DataFrame:
        path = f"{self.root}/{layer}/{name}"
        writer = _laid_out(df, partition).write.mode("overwrite")
        (writer.partitionBy(partition) if partition else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)


class VersionedSink(ParquetSink):
    """``<root>/versions/<run>/<layer>/<name>``: each run in a folder of its own, which readers find once it is published.

    Publishing writes one small file, which is moved to its place when complete: readers see the run before or this one as a
    whole. A run that fails is never published.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, f"{root}/versions/{uuid.uuid4().hex}")
        self.base = root

    def publish(self, number: int) -> None:
        """Make this run the one of the highest number. A number is given once."""
        self.spark.createDataFrame([(number, self.root)], "number long, folder string").coalesce(1).write.parquet(
            f"{self.base}/published/{number:09d}"
        )


def published(spark: SparkSession, root: str) -> str:
    """The folder of the run that was published with the highest number."""
    runs = spark.read.schema("number long, folder string").parquet(f"{root}/published/*")
    return runs.orderBy(F.col("number").desc()).first()["folder"]


class CatalogSink:
    """``<layer>.<name>`` in the session catalog."""

    def __init__(self, spark: SparkSession, file_format: str = "parquet"):
        self.spark, self.file_format = spark, file_format

    def write(self, df: DataFrame, layer: str, name: str, partition: str | None) -> DataFrame:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        writer = _laid_out(df, partition).write.mode("overwrite").format(self.file_format)
        (writer.partitionBy(partition) if partition else writer).saveAsTable(f"{layer}.{name}")
        return self.spark.table(f"{layer}.{name}").select(*df.columns)


def load_raw(source: Source, sink: Sink) -> None:
    """Copy the raw tables, for instance headed CSV files, into typed tables of the layer ``raw``."""
    for system, tables in RAW_TABLES.items():
        for table in tables:
            sink.write(source.read(system, table), "raw", table, None)


def build(project: Project, sink: Sink) -> Project:
    """Write everything, each table from the written ones before it, and return the project reading those."""

    def store(name: str, layer: str) -> None:
        project.replace(name, sink.write(project.table(name), layer, name, PARTITIONS.get(name)))

    for name in STAGING:
        if name in SHARED:
            store(name, "staging")
        project.table(name).createOrReplaceTempView(name)
    for name in INTERMEDIATE:
        if name in SHARED:
            store(name, "intermediate")
    for name in CORE:
        store(name, "marts")
    for name in REPORTING:
        store(name, "reporting")
    return project
