"""Session defaults and the shared folder for data that must outlive its executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "subledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on: UTC, ANSI arithmetic, adaptive execution."""
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Recording the Python line of every column expression triples the time it takes to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**options, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for checkpoints and written intermediates (``spark.checkpoint.dir``).

    Only a local session, which has no other machine to share with, may do without: it gets a folder of its own that is
    gone when the program ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="subledger-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one, so that runs never overwrite each other."""
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


def materialized(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there, with the lineage cut.

    Parquet rather than an RDD checkpoint: later reads still prune columns.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/data"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
