"""Intake channels as streams.

The checkpoint replaces a position tracker, `maxFilesPerTrigger` replaces
backpressure, and the trigger replaces a polling timer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from harborline.plans.batch import run_batch
from harborline.sources import tables as table_source, webhook

REPLAY_WINDOW = "5 minutes"
# Files per micro-batch.  Bounds what a backlog puts into one batch, and with
# it what a stateful operator may see of one key at a time.
MAX_FILES = 1000


def read_table(spark: SparkSession, path: str, max_files: int = MAX_FILES,
               schema: T.StructType | None = None) -> DataFrame:
    """Landing folder (or glob) of Parquet files as a stream."""
    return (spark.readStream.schema(schema or spark.read.parquet(path).schema)
            .option("maxFilesPerTrigger", max_files).parquet(path))


def read_drop(spark: SparkSession, path: str, glob: str | None = None,
              max_files: int = MAX_FILES) -> DataFrame:
    """New files in a folder or bucket, with their bytes."""
    schema = T.StructType([
        T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    reader = (spark.readStream.format("binaryFile").schema(schema)
              .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str,
          every: str | None = None) -> StreamingQuery:
    """Run `work(batch, batch_id)` per micro-batch: all that is there and stop,
    or `every` interval."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """Sink that owns one directory per micro-batch; a replay overwrites it."""
    def work(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return work


def process_to(store: str, to_documents: Callable[[DataFrame], DataFrame],
               rule=None) -> Callable[[DataFrame, int], None]:
    """Micro-batch through the full batch run, effectively once: every table
    is overwritten per batch and ids stored earlier are never stored again."""
    def work(batch: DataFrame, batch_id: int) -> None:
        run_batch(to_documents(batch), store, batch_id, rule)

    return work


def webhook_stream(deliveries: DataFrame, secret: str | None, window: str = REPLAY_WINDOW) -> DataFrame:
    """Verified, acquiring deliveries; a delivery id that arrives again within
    the window is dropped.  State holds ids for the window only."""
    return _first_arrivals(webhook.acquiring(webhook.events(deliveries, secret)), ["delivery_id"], window)


def bounded_dedup(docs: DataFrame, window: str = "1 hour", keys: list[str] = ("id",)) -> DataFrame:
    """Recent repeats are dropped with state bounded by time; the repository
    anti join stays the authority for older ones."""
    return _first_arrivals(docs, list(keys), window)


def remembered(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What a stream's stateful operator holds (key, value, partition_id), as its last
    finished micro-batch left it: read from the checkpoint, without the stream."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def _first_arrivals(rows: DataFrame, keys: list[str], window: str) -> DataFrame:
    """The window runs over arrival, not over a time in the data: a backlog
    read in any order has no late rows, so none is lost."""
    return (rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", window)
            .dropDuplicatesWithinWatermark(keys).drop("_arrived"))


def cdc_stream(changes: DataFrame, instance_id: str) -> DataFrame:
    return table_source.cdc_documents(changes, instance_id)
