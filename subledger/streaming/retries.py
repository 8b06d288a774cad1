"""Webhook retries on a stream of raw orders.

Each batch is reduced to one row per order and compared with the orders already written, so nothing is dropped for being
late: an order whose first delivery arrives weeks after its time is written like any other. ``lateness`` only bounds the
search for duplicates, to orders written with a time that close to the delivery's; a retry beyond it is written a second
time, and the batch tables' own dedup, run over ``read_orders`` or the raw deliveries, takes it out. No state is kept but
the table itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from subledger.plans import staging
from subledger.settings import Settings
from subledger.sources import raw_schema

# How the table is laid out: by the batch that wrote a row, so that a repeated batch replaces its own rows, and by day.
_BATCH, _DAY = "batch_id", "order_day"


def read_deliveries(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Raw orders as they land in a folder of Parquet files."""
    reader = spark.readStream.schema(raw_schema("shopify", "raw_shopify__orders"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def first_deliveries(path: str, settings: Settings, lateness_days: int = 2) -> Callable[[DataFrame, int], None]:
    """What to do with a batch of deliveries: write those of orders not written before.

    Of several deliveries in one batch the earliest stays, as in the batch tables. A batch that is repeated after a failure
    does not see what it wrote the first time and overwrites it.
    """

    def write(deliveries: DataFrame, batch: int) -> None:
        orders = staging.shop_orders(deliveries, settings).withColumn(_DAY, F.to_date("order_created_at_utc"))
        earlier = written(deliveries.sparkSession, path, orders)
        if earlier is not None:
            seen = earlier.filter(F.col(_BATCH) < batch).select(
                F.col("order_id").alias("_id"), F.col(_DAY).alias("_day")
            )
            close = F.abs(F.date_diff(_DAY, F.col("_day"))) <= lateness_days
            both_undated = F.col(_DAY).isNull() & F.col("_day").isNull()
            orders = orders.join(seen, (F.col("order_id") == F.col("_id")) & (close | both_undated), "left_anti")
        laid_out = orders.withColumn(_BATCH, F.lit(batch).cast("bigint"))
        laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BATCH, _DAY).parquet(path)

    def written(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
        """The table so far, if there is one. Only the days near the batch's are read: partitions far off are pruned."""
        schema = like.schema.add(_BATCH, "long")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        first, last, undated = like.agg(F.min(_DAY), F.max(_DAY), F.count_if(F.col(_DAY).isNull())).first()
        days = F.col(_DAY).between(F.date_sub(F.lit(first), lateness_days), F.date_add(F.lit(last), lateness_days)) if first else F.lit(False)
        return spark.read.schema(schema).parquet(path).filter(days | F.col(_DAY).isNull() if undated else days)

    return write


def write_orders(
    deliveries: DataFrame, path: str, checkpoint: str, settings: Settings, lateness_days: int = 2, available_now: bool = False
) -> StreamingQuery:
    """Keep a table of cleaned orders up to date with a stream of deliveries; ``checkpoint`` must survive the cluster."""
    writer = deliveries.writeStream.foreachBatch(first_deliveries(path, settings, lateness_days)).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned orders written so far, in the columns of the batch table."""
    return spark.read.parquet(path).drop(_BATCH, _DAY)
