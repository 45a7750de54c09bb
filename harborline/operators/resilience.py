"""Retry schedule and runs of failures as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.catalog import values as V
from harborline.functions.classify import retryable
from harborline.operators.ordered import running


def _policy(name: Column, field: int) -> Column:
    expr = F.lit(None).cast("double")
    for policy, parts in V.RETRY_POLICIES.items():
        expr = F.when(name == policy, float(parts[field])).otherwise(expr)
    return expr


def retry_due(failures: DataFrame, op: str = "op_id", order: str = "seq",
              policy: str = "policy") -> DataFrame:
    """When each failed attempt may be retried, or that it may not.

    Input: one row per failed attempt (op, order, ts, error_type,
    retry_after_s, policy).  Rate limits wait what the source asked for and do
    not lengthen later waits; other retryable errors do.
    """
    limited = F.col("error_type") == "ConnectorRateLimitError"
    counted = running(failures, [op], order, {
        "_before": ("sum", F.lit(1)), "_growing": ("sum", F.when(limited, 0).otherwise(1)),
    }, inclusive=False)
    name = F.col(policy)
    backoff = F.least(_policy(name, 1) * F.pow(_policy(name, 3), F.col("_growing").cast("double")),
                      F.greatest(_policy(name, 1), _policy(name, 2)))
    attempt = F.col("_before") + 1
    fatal = ~retryable(F.col("error_type"))
    exhausted = ~fatal & (attempt >= _policy(name, 0))
    wait = (F.when(fatal | exhausted, F.lit(None).cast("double"))
            .when(limited & F.col("retry_after_s").isNotNull(), F.col("retry_after_s") * 1000.0)
            .otherwise(backoff))
    due = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp"))
                             + F.round(F.col("wait_ms") * 1000).cast("bigint"))
    return (counted.withColumn("attempt", attempt).withColumn("fatal", fatal)
            .withColumn("exhausted", exhausted).withColumn("wait_ms", wait)
            .withColumn("next_attempt_at", due).drop("_before", "_growing"))


def failure_runs(calls: DataFrame, resource: str = "resource_id", order: str = "seq",
                 threshold: int = V.BREAKER_FAILURES, chunk: Column | None = None) -> DataFrame:
    """Adds `failure_run`, consecutive failures up to and including each call,
    and `tripped`, whether they reached `threshold`: what to look at before a
    resource is called again.  Running counts over chunks, no whole log in one
    task."""
    counted = running(calls, [resource], order, {
        "_calls": ("sum", F.lit(1)), }, chunk=chunk)
    seen = running(counted, [resource], order, {
        "_good": ("max", F.when(F.col("ok"), F.col("_calls")))}, chunk=chunk)
    run = (F.col("_calls") - F.coalesce("_good", F.lit(0))).cast("bigint")
    return (seen.withColumn("failure_run", run).withColumn("tripped", F.col("failure_run") >= threshold)
            .drop("_calls", "_good"))
