"""Live health alerts: a row when a resource's calls turn from good to bad or back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from harborline.operators.ordered import previous

ALERT = "resource_id string, seq bigint, previous string, current string"
STATE = "resource_id string, seq bigint, ok boolean"


def _word(healthy: Column) -> Column:
    return F.when(healthy, "HEALTHY").otherwise("UNHEALTHY")


def alerts_to(store: str, chunk: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Work for a stream of calls (resource_id, seq, ok): flips go to
    `store`/alerts, the last call of every resource to `store`/state, both in
    a directory per micro-batch that a replay overwrites.

    Within a batch each call is compared with the one before it by the chunked
    running operator, so a resource that owns most calls is not gathered; the
    first call of a resource is compared with the state the last batch left.
    The state is one thin row per resource.
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        calls = batch.select("resource_id", "seq", "ok")
        left = (spark.read.schema(STATE).parquet(f"{store}/state/batch_id={batch_id - 1}") if batch_id
                else spark.createDataFrame([], STATE))
        seen = previous(calls, ["resource_id"], "seq", F.col("ok"), "was", chunk)
        known = left.select(F.col("resource_id").alias("_r"), F.col("ok").alias("_ok"))
        was = F.coalesce("was", "_ok")
        flips = (seen.join(known, F.col("resource_id").eqNullSafe(F.col("_r")), "left")
                 .where(was != F.col("ok"))
                 .select("resource_id", "seq", _word(was).alias("previous"), _word(F.col("ok")).alias("current")))
        flips.write.mode("overwrite").parquet(f"{store}/alerts/batch_id={batch_id}")
        last = (left.unionByName(calls).groupBy("resource_id")
                .agg(F.max(F.struct("seq", "ok")).alias("l")).select("resource_id", "l.seq", "l.ok"))
        last.write.mode("overwrite").parquet(f"{store}/state/batch_id={batch_id}")

    return work


def stored_alerts(spark, store: str) -> DataFrame:
    return spark.read.schema(f"{ALERT}, batch_id int").parquet(f"{store}/alerts").drop("batch_id")
