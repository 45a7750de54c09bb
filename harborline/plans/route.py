"""Route a batch: validate, de-duplicate, decide done / skipped / failed.

Content is read once.  Everything after validation works on a thin row
(seq, id, references, error): no shuffle ever carries document bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.operators.dedup import mark_first
from harborline.operators.validate import Rule, validated
from harborline.session import materialize

THIN = ["seq", "id", "connector_id", "instance_id", "uri", "content_type", "size_bytes",
        "checksum", "version", "cursor", "error"]


def thin(docs: DataFrame, rule: Column | Rule | None = None) -> DataFrame:
    checked = validated(docs, rule)
    ref = F.col("source_ref")
    return checked.select(
        "seq", "id", ref["connector_id"].alias("connector_id"),
        ref["instance_id"].alias("instance_id"), ref["uri"].alias("uri"),
        "content_type", "size_bytes", "checksum", ref["version"].alias("version"),
        "cursor", "error")


def route(docs: DataFrame, known: DataFrame | None = None, rule: Column | Rule | None = None,
          key: list[str] = ("id",)) -> DataFrame:
    """One decision row per document: THIN plus `status` and `reason`.

    The thin rows are stored in the shared folder first, because both the
    winner search and the flag join read them.
    """
    return decide(materialize(thin(docs, rule), "thin"), known, key)


def decide(rows: DataFrame, known: DataFrame | None = None,
           key: list[str] = ("id",)) -> DataFrame:
    """Decisions for validated thin rows; `key` may add the version to keep
    every version of a document."""
    valid = F.col("error").isNull()
    marked = mark_first(rows, list(key), "seq", valid, known)
    status = (F.when(~valid, "failed").when(F.col("is_first"), "done").otherwise("skipped"))
    reason = (F.when(~valid, F.col("error.message"))
              .when(F.col("is_first"), "").otherwise("duplicate"))
    return marked.select(*THIN, status.alias("status"), reason.alias("reason"))


def summary(routed: DataFrame) -> DataFrame:
    return routed.groupBy("status").agg(F.count("*").alias("documents"),
                                        F.sum("size_bytes").alias("bytes"))


def cycle_result(routed: DataFrame) -> DataFrame:
    """Found / processed / skipped / failed of one run, in one row."""
    n = lambda s: F.count_if(F.col("status") == s)
    return (routed.agg(F.count("*").alias("found"), n("done").alias("processed"),
                       n("skipped").alias("skipped"), n("failed").alias("failed"))
            .withColumn("success", F.col("failed") == 0)
            .withColumn("has_work", F.col("found") > 0))
