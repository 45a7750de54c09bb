"""A full batch run: route, then append documents, dead letters, events, the
job row and, last of all, the new positions.

Every table is laid out by `batch_id` and a run overwrites its own directory,
so running a batch again changes nothing.
"""

from __future__ import annotations

from harborline.session import materialize
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harborline.operators import deadletter
from harborline.operators.cursors import advance_done
from harborline.operators.repository import Repository
from harborline.operators.validate import Rule
from harborline.plans.route import cycle_result, decide, thin

# Above this many instances in one batch, stored ids are not narrowed to the
# batch's instances by a literal partition filter.
PRUNE_INSTANCES = 1000
# Largest number of row numbers sent to every task (8 bytes each).
BROADCAST_ROWS = 1_000_000


def events(routed: DataFrame, batch: Column, at: Column | None = None) -> DataFrame:
    """One event per routed document.  Ids are a function of (batch, row)."""
    status = F.col("status")
    kind = (F.when(status == "done", "RawDocumentCreated")
            .when(status == "skipped", "DocumentDeduplicated").otherwise("AcquisitionFailed"))
    detail = (F.when(status == "done", F.to_json(F.struct("content_type", "size_bytes")))
              .when(status == "skipped",
                    F.to_json(F.struct(F.lit("id_hash").alias("dedup_strategy"))))
              .otherwise(F.to_json(F.struct(F.lit("validation").alias("failure_type"),
                                            F.col("reason").alias("error_message")))))
    return routed.select(
        F.sha2(F.concat_ws(":", batch.cast("string"), F.col("seq").cast("string"), kind), 256)
        .alias("event_id"),
        (at if at is not None else F.current_timestamp()).alias("occurred_at"),
        kind.alias("event_type"), F.col("id").alias("document_id"), "connector_id",
        "instance_id", "uri", detail.alias("detail"))


def _known_ids(repo: Repository, rows: DataFrame, batch_id: int) -> DataFrame:
    """Ids stored by earlier batches, read only from this batch's instances
    when these are few (checked, then pushed as a partition filter)."""
    stored = repo.ids_before(batch_id)
    seen = rows.select("instance_id").distinct().limit(PRUNE_INSTANCES + 1).collect()
    if len(seen) <= PRUNE_INSTANCES:
        stored = stored.where(F.col("instance_id").isin([r[0] for r in seen if r[0] is not None]))
    return stored.select("id")


def _rows_of(docs: DataFrame, routed: DataFrame, status: str, counts) -> DataFrame:
    """The documents with one outcome.  Whichever of "these rows" and "the
    other rows" is few enough to send to every task (a checked count) is sent
    as bare row numbers, so that document bytes stay where they are; only when
    both are many is there a shuffle on `seq`."""
    hit = routed.where(F.col("status") == status).select("seq")
    n = counts[_COUNTED[status]]
    if n == counts["found"]:
        return docs
    if n <= BROADCAST_ROWS:
        return docs.join(F.broadcast(hit), "seq", "left_semi")
    if counts["found"] - n <= BROADCAST_ROWS:
        return docs.join(F.broadcast(routed.where(F.col("status") != status).select("seq")),
                         "seq", "left_anti")
    return docs.join(hit, "seq", "left_semi")


_COUNTED = {"done": "processed", "skipped": "skipped", "failed": "failed"}


def run_batch(docs: DataFrame, store: str, batch_id: int,
              rule: Column | Rule | None = None, compact: bool = False) -> DataFrame:
    """Process `docs` (RAW_DOCUMENTS; `seq` unique and reproducible) into the
    tables under `store`; returns the one-row cycle result.

    The documents are landed in the shared folder first: sources are parsed
    once, and `seq`, by which rows are found again, can't change between reads.
    What is shuffled in between are thin rows.
    """
    spark, store = docs.sparkSession, store.rstrip("/")
    docs = materialize(docs, "landed")
    repo = Repository(spark, f"{store}/repository")
    table = lambda name: f"{store}/{name}/batch_id={batch_id}"

    def save(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(table(name))
        return spark.read.schema(df.schema).parquet(table(name))

    rows = save(thin(docs, rule), "checked")
    routed = save(decide(rows, _known_ids(repo, rows, batch_id)), "routed")
    result = save(cycle_result(routed).withColumn("finished_at", F.current_timestamp()), "jobs")
    counts = result.first()

    repo.append(_rows_of(docs, routed, "done", counts), batch_id, compact)
    failed = deadletter.enqueue(routed, batch=F.lit(batch_id))
    kept = [c for c in docs.columns if c != "seq"]
    bodies = _rows_of(docs, routed, "failed", counts).select("seq", F.struct(*kept).alias("document"))
    save(failed.join(bodies, "seq"), "dlq")
    save(events(routed, F.lit(batch_id)), "events")
    save(advance_done(routed).withColumn("cursor_key", F.lit("")), "cursors")
    return result.drop("finished_at")


def positions(spark: SparkSession, store: str) -> DataFrame:
    """Current position per instance: that of its latest batch."""
    log = spark.read.parquet(f"{store.rstrip('/')}/cursors")
    return (log.groupBy("connector_id", "instance_id", "cursor_key")
            .agg(F.max_by(F.struct("value", "source_type"), "batch_id").alias("c"))
            .select("connector_id", "instance_id", "cursor_key", "c.*"))


def replay(entries: DataFrame, dismissals: DataFrame, known: DataFrame,
           rule: Column | Rule | None = None) -> DataFrame:
    """Route active dead letters again; `attempt_count` grows by one.

    `entries` carry the failed document as struct `document` and `seq`.
    """
    again = deadletter.active(entries, dismissals)
    docs = again.select("seq", "document.*")
    return (decide(thin(docs, rule), known)
            .join(again.select("seq", "entry_id", (F.col("attempt_count") + 1)
                               .alias("attempt_count")), "seq"))
