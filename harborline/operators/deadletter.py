"""Dead letters: an append-only table of failed documents and one of
dismissals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from harborline.catalog import values as V


@dataclass(frozen=True)
class DeadLetterFilters:
    connector_id: str | None = None
    instance_id: str | None = None
    failure_type: str | None = None
    since: str | None = None
    dismissed: bool = False
    limit: int = V.LISTING_LIMIT


def enqueue(failed: DataFrame, failure_type: str = "VALIDATION", batch: Column | None = None,
            failed_at: Column | None = None, attempt: Column | None = None,
            document: list[str] | None = None) -> DataFrame:
    """Dead-letter rows from rows with `error` set; `document` names the
    columns to keep as the failed document.  The entry id is a function of
    (batch, row), so a replayed batch produces the same entries."""
    kept = [F.struct(*document).alias("document")] if document else []
    batch = F.lit("") if batch is None else batch.cast("string")
    return failed.where("error is not null").select(
        F.sha2(F.concat(batch, F.lit(":"), F.col("seq").cast("string")), 256).alias("entry_id"),
        F.col("id").alias("document_id"), F.lit(failure_type).alias("failure_type"),
        F.col("error.error_type").alias("error_type"),
        F.col("error.message").alias("error_message"),
        "connector_id", "instance_id", "uri", "seq",
        (attempt if attempt is not None else F.lit(1)).cast("int").alias("attempt_count"),
        (failed_at if failed_at is not None else F.current_timestamp()).alias("failed_at"), *kept)


def dismissal(entries: DataFrame, reason: Column | str, at: Column | None = None) -> DataFrame:
    """Rows to append to the dismissals table."""
    reason = reason if isinstance(reason, Column) else F.lit(reason)
    return entries.select("entry_id", reason.alias("reason"),
                          (at if at is not None else F.current_timestamp()).alias("dismissed_at"))


def with_dismissals(entries: DataFrame, dismissals: DataFrame) -> DataFrame:
    """Entries with `dismissed` and the last reason."""
    last = dismissals.groupBy("entry_id").agg(
        F.max_by("reason", "dismissed_at").alias("dismiss_reason"))
    return (entries.join(last.withColumn("_hit", F.lit(True)), "entry_id", "left")
            .withColumn("dismissed", F.coalesce("_hit", F.lit(False))).drop("_hit"))


def active(entries: DataFrame, dismissals: DataFrame) -> DataFrame:
    return entries.join(dismissals.select("entry_id"), "entry_id", "left_anti")


def matching(entries: DataFrame, f: DeadLetterFilters) -> DataFrame:
    """`dismissed=True` lists both kinds."""
    out = entries if f.dismissed else entries.where(~F.col("dismissed"))
    for name in ("connector_id", "instance_id", "failure_type"):
        wanted = getattr(f, name)
        if wanted:
            out = out.where(F.col(name) == wanted)
    return out.where(F.col("failed_at") >= F.lit(f.since).cast("timestamp")) if f.since else out


def listing(entries: DataFrame, f: DeadLetterFilters) -> DataFrame:
    """Oldest first, at most `limit`."""
    return matching(entries, f).orderBy("failed_at", "entry_id").limit(f.limit)


def get(entries: DataFrame, entry_id: Column | str) -> DataFrame:
    return entries.where(F.col("entry_id") == entry_id)


def stats(entries: DataFrame) -> DataFrame:
    """Active entries in total, by failure type and by connector, with the
    oldest failure: one pass, three grouping sets."""
    a, b = F.col("failure_type"), F.col("connector_id")
    return (entries.where(~F.col("dismissed")).groupingSets([[a], [b], []], a, b)
            .agg(F.count("*").alias("entries"), F.min("failed_at").alias("oldest"))
            .select("failure_type", "connector_id", "entries", "oldest"))


def size(entries: DataFrame) -> DataFrame:
    return entries.agg(F.count_if(~F.col("dismissed")).alias("active"))
