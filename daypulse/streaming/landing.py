"""Incremental, replayable landing of JSON files with Structured Streaming.

Files arrive under ``<landing>/partition_date=YYYY-MM-DD/``. A micro-batch reads its own
new files and writes its own folder of each day it touches,
``<root>/<feed>/partition_date=.../load_id=<batch>/``, by dynamic partition overwrite: a batch
that is replayed after a failure overwrites exactly what it had written, and no batch reads
or rewrites what earlier ones landed. Records whose day is NULL (an unreadable folder name)
go to ``<root>/<feed>_rejects/load_id=<batch>/`` and the stream goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import path_exists
from ..sources.feeds import FeedSpec, feed
from .compaction import read_compacted

LANDING_SCHEMA = "raw_data variant, partition_date date"


def landing_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    r = (spark.readStream.format("json").option("singleVariantColumn", "raw_data")
         .schema(LANDING_SCHEMA))
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(landing)


def write_batch(batch: DataFrame, root: str, name: str, load_id: int) -> None:
    """Write one load: its records by day, those without a day to the reject table."""
    def put(df: DataFrame, path: str, by: list[str]) -> None:
        (df.withColumn("load_id", F.lit(load_id)).hint("rebalance", *by).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))

    batch = batch.persist()
    try:
        dated = F.col("partition_date").isNotNull()
        put(batch.where(dated), f"{root}/{name}", ["partition_date", "load_id"])
        if not batch.where(~dated).isEmpty():
            put(batch.where(~dated).drop("partition_date"), f"{root}/{name}_rejects", ["load_id"])
    finally:
        batch.unpersist()


def read_streamed(spark: SparkSession, root: str, name: str,
                  registry: dict[str, FeedSpec] | None = None) -> DataFrame:
    """The raw table of all loads, compacted or not: ``raw_data VARIANT, partition_date DATE``."""
    feed(name, registry)
    return read_compacted(spark, root, name)


def read_rejects(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``raw_data VARIANT, load_id`` of the records that had no day; empty if there are none."""
    path = f"{root}/{name}_rejects"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "raw_data variant, load_id int")
    return spark.read.option("basePath", path).parquet(path)


def start_landing(spark: SparkSession, landing: str, root: str, name: str, checkpoint: str,
                  registry: dict[str, FeedSpec] | None = None, available_now: bool = True,
                  max_files: int | None = None) -> StreamingQuery | None:
    """Start the stream; with ``available_now`` it processes what is there and stops.

    Returns ``None`` when the landing folder does not exist yet (nothing landed). The
    load id is the stream's batch number, so one table needs one checkpoint.
    """
    feed(name, registry)
    if not path_exists(spark, landing):
        return None

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        write_batch(batch, root, name, epoch_id)

    w = (landing_stream(spark, landing, max_files).writeStream.foreachBatch(each_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
