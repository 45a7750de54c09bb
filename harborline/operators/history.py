"""Changes between consecutive log rows.  Built on `ordered.previous`, so a
job or instance that fills most of the log is still cut into chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.catalog import values as V
from harborline.operators.ordered import previous


def job_transitions(log: DataFrame, job: str = "job_id", order: str = "seq",
                    chunk: Column | None = None) -> DataFrame:
    """Status moves with `legal`; a job's first row is no move."""
    rows = previous(log, [job], order, F.col("status"), "previous_status", chunk)
    moves = [f"{a}>{b}" for a, b in V.JOB_MOVES]
    move = F.concat("previous_status", F.lit(">"), F.col("status"))
    return rows.where("previous_status is not null").withColumn("legal", move.isin(moves))


def health_changes(log: DataFrame, instance: str = "instance_id", order: str = "seq",
                   chunk: Column | None = None) -> DataFrame:
    """Rows where an instance's health differs from its probe before."""
    rows = previous(log, [instance], order, F.col("healthy"), "was_healthy", chunk)
    return rows.where("was_healthy <> healthy")
