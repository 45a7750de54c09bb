"""The document repository: first write wins, status per document as a log.

Layout: `documents/batch_id=N/connector_id=C/instance_id=I/*.parquet`,
`status/batch_id=N/*.parquet`.  A batch owns its directory and overwrites it,
so a replayed batch changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from harborline.catalog import values as V
from harborline.operators.dedup import keep_first
from harborline.schema import DOCUMENT_STATUS_LOG, RAW_DOCUMENTS

STORED = T.StructType([*RAW_DOCUMENTS.fields,
                       T.StructField("created_at", T.TimestampType()),
                       T.StructField("batch_id", T.LongType()),
                       T.StructField("connector_id", T.StringType()),
                       T.StructField("instance_id", T.StringType())])


@dataclass(frozen=True)
class Filters:
    status: str | None = None
    connector_id: str | None = None
    instance_id: str | None = None
    workspace_id: str | None = None
    content_type: str | None = None
    since: datetime | str | None = None
    until: datetime | str | None = None
    limit: int = V.LISTING_LIMIT
    offset: int = 0


def insert_absent(docs: DataFrame, stored: DataFrame) -> DataFrame:
    """Documents the repository would add: the first of each id it lacks."""
    first = keep_first(docs.select("seq", "id"), ["id"], known=stored.select("id"))
    return docs.join(first.select("seq"), "seq", "left_semi")


def current_status(entries: DataFrame, log: DataFrame) -> DataFrame:
    """Entries with status, attempts, last error and last processor.  The log
    is folded per id before it meets the entries."""
    at = F.struct("updated_at", "log_seq") if "log_seq" in log.columns else F.col("updated_at")
    given = lambda c: F.when(F.length(c) > 0, at)
    state = log.groupBy("id").agg(
        F.max_by("status", at).alias("status"),
        F.count_if(F.col("status") == "PROCESSING").alias("attempts"),
        F.max_by("error", given("error")).alias("processing_error"),
        F.max_by("processed_by", given("processed_by")).alias("processed_by"),
        F.max("updated_at").alias("updated_at"))
    return (entries.join(state, "id", "left")
            .withColumn("status", F.coalesce("status", F.lit("PENDING")))
            .withColumn("attempts", F.coalesce("attempts", F.lit(0)))
            .withColumn("updated_at", F.coalesce("updated_at", "created_at")))


def matching(entries: DataFrame, f: Filters) -> DataFrame:
    out = entries
    for name in ("status", "connector_id", "instance_id", "workspace_id", "content_type"):
        wanted = getattr(f, name)
        if wanted:
            out = out.where(F.col(name) == wanted)
    if f.since:
        out = out.where(F.col("created_at") >= F.lit(f.since).cast("timestamp"))
    if f.until:
        out = out.where(F.col("created_at") <= F.lit(f.until).cast("timestamp"))
    return out


def query(entries: DataFrame, f: Filters) -> DataFrame:
    page = matching(entries, f).orderBy("created_at", "id")
    return (page.offset(f.offset) if f.offset else page).limit(f.limit)


def count(entries: DataFrame, f: Filters) -> DataFrame:
    return matching(entries, f).agg(F.count("*").alias("documents"))


def read_one(entries: DataFrame, document_id: str) -> DataFrame:
    """Entry by id.  `content` is not selected, so the scan never loads it."""
    return entries.where(F.col("id") == document_id).drop("content")


def exists(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    return candidates.join(stored.select("id"), "id", "left_semi")


def status_change(ids: DataFrame, status: str, error: str | None = None,
                  processed_by: str | None = None, at=None) -> DataFrame:
    """Rows to append to the status log."""
    return ids.select("id", F.lit(status).alias("status"),
                      F.lit(error).cast("string").alias("error"),
                      F.lit(processed_by).cast("string").alias("processed_by"),
                      (at if at is not None else F.current_timestamp()).alias("updated_at"))


class Repository:
    """A repository on a shared path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        folder = f"{self.path}/{name}"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(hadoop):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def stored(self) -> DataFrame:
        return self._table("documents", STORED)

    def log(self) -> DataFrame:
        return self._table("status", T.StructType(
            [*DOCUMENT_STATUS_LOG.fields, T.StructField("batch_id", T.LongType())]))

    def entries(self) -> DataFrame:
        return current_status(self.stored(), self.log())

    def ids_before(self, batch_id: int) -> DataFrame:
        """Stored ids as earlier batches left them (a replay must not see its
        own first attempt)."""
        return self.stored().where(F.col("batch_id") < batch_id).select(
            "id", "connector_id", "instance_id")

    def append(self, docs: DataFrame, batch_id: int, compact: bool = False) -> None:
        """Write a batch's new documents from where they are.  `compact` moves
        them first, to files of even size, and splits an instance that holds
        most of the batch; worth it when tasks hold many small instances."""
        ref = F.col("source_ref")
        rows = (docs.withColumn("created_at", F.current_timestamp())
                .withColumn("connector_id", ref["connector_id"])
                .withColumn("instance_id", ref["instance_id"]))
        if compact:
            rows = rows.hint("rebalance", "connector_id", "instance_id")
        (rows.write.mode("overwrite").partitionBy("connector_id", "instance_id")
         .parquet(f"{self.path}/documents/batch_id={batch_id}"))

    def write(self, docs: DataFrame, batch_id: int) -> None:
        """Insert-if-absent."""
        self.append(insert_absent(docs, self.ids_before(batch_id)), batch_id)

    def read(self, document_id: str) -> DataFrame:
        return read_one(self.entries(), document_id)

    def exists(self, candidates: DataFrame) -> DataFrame:
        return exists(candidates, self.stored())

    def query(self, f: Filters) -> DataFrame:
        return query(self.entries(), f).drop("content")

    def count(self, f: Filters) -> DataFrame:
        return count(self.entries(), f)

    def update_status(self, ids: DataFrame, status: str, batch_id: int, **detail) -> None:
        """Append a status change; unknown ids are ignored."""
        known = exists(ids.select("id").distinct(), self.stored())
        (status_change(known, status, **detail).write.mode("overwrite")
         .parquet(f"{self.path}/status/batch_id={batch_id}"))
