"""Job, session, metric, quota and health reports: map-side combined
aggregates only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window as W, Column, DataFrame, functions as F

from harborline.catalog import values as V
from harborline.schema import TERMINAL_JOB_STATUSES
from harborline.session import materialize


def n_status(status: str, column: str = "status") -> Column:
    return F.count_if(F.col(column) == status)


def job_counters(results: DataFrame, job: str = "job_id") -> DataFrame:
    """Per-job counters from per-document results."""
    return (results.groupBy(job)
            .agg(n_status("done").alias("acquired"), n_status("skipped").alias("skipped"),
                 n_status("failed").alias("failed"))
            .withColumn("total", F.col("acquired") + F.col("skipped") + F.col("failed"))
            .withColumn("success_rate", F.try_divide(F.col("acquired"), F.col("total"))))


def job_duration(jobs: DataFrame) -> DataFrame:
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return (jobs.withColumn("duration_ms", (micros("completed_at") - micros("started_at")) / 1000.0)
            .withColumn("terminal", F.col("status").isin(*TERMINAL_JOB_STATUSES)))


def session_totals(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("session_id").agg(
        F.count("*").alias("total_jobs"), n_status("COMPLETED").alias("successful_jobs"),
        n_status("FAILED").alias("failed_jobs"),
        F.sum("documents_acquired").alias("documents_acquired"),
        F.sum("documents_failed").alias("documents_failed"))


def session_liveness(beats: DataFrame, now: Column | None = None) -> DataFrame:
    """Last heartbeat and uptime; a running session's uptime ends `now`."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    end = F.max("ts") if now is None else F.coalesce(F.max("stopped_at"), now)
    return beats.groupBy("session_id").agg(
        F.max("ts").alias("last_heartbeat"),
        ((micros(end) - micros(F.min("ts"))) / 1_000_000.0).alias("uptime_s"))


def counter_by_labels(observations: DataFrame, labels: list[str],
                      amount: str = "count") -> DataFrame:
    """Counter per label set and in total (all labels null, `is_total`)."""
    cols = [F.col(c) for c in labels]
    return (observations.groupingSets([cols, []], *cols)
            .agg(F.sum(amount).alias("value"),
                 (F.grouping(labels[0]) == 1).alias("is_total"))
            .select(*labels, "value", "is_total"))


MARKS = (0.5, 0.95, 0.99)
_CUTS = 200
#: Distinct (label, value) pairs up to which one aggregate holds a label's values.
FEW_VALUES = 200_000


def histogram(observations: DataFrame, labels: list[str], value: str = "value",
              accuracy: int | None = None) -> DataFrame:
    """Observation count and p50 / p95 / p99 per label set.

    Exact by default: equal observations are counted before the shuffle.  Few
    distinct values are ranked by one aggregate.  Of many, each label's are cut at
    approximate quantiles, so that a label that owns most values is spread over
    some 200 groups, and ranks run on from one group to the next.  `accuracy`
    switches to the mergeable sketch.  Nulls count as observations and have no rank.
    """
    if accuracy:
        out = observations.groupBy(*labels).agg(
            F.count("*").alias("observations"),
            F.percentile_approx(value, list(MARKS), accuracy).alias("p"))
        return out.select(*labels, "observations", *[F.col("p")[i].alias(n) for i, n in enumerate(("p50", "p95", "p99"))])
    counted = materialize(observations.groupBy(*labels, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n")),
                          "values")
    if counted.count() <= FEW_VALUES:
        known = F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(F.lit(0))
        out = counted.groupBy(*labels).agg(
            F.sum("_n").alias("observations"),
            F.percentile(F.coalesce("_v", F.lit(0.0)), list(MARKS), known).alias("p"))
        return out.select(*labels, "observations", *[F.col("p")[i].alias(n) for i, n in enumerate(("p50", "p95", "p99"))])
    head = counted.groupBy(*labels).agg(
        F.sum("_n").alias("observations"), F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))), F.lit(0)).alias("_all"),
        F.percentile_approx("_v", [i / _CUTS for i in range(1, _CUTS)], 10 * _CUTS).alias("_cuts"))
    head = head.withColumnsRenamed({k: f"_h_{k}" for k in labels})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in labels])
    placed = counted.join(head, same).drop(*[f"_h_{k}" for k in labels]).withColumn(
        "_c", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
    group = [*labels, "_c"]
    before = W.partitionBy(*labels).orderBy("_c").rowsBetween(W.unboundedPreceding, -1)
    base = placed.where("_v is not null").groupBy(*group).agg(F.sum("_n").alias("_t")).withColumn(
        "_base", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t").withColumnsRenamed({k: f"_b_{k}" for k in group})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in group])
    within = W.partitionBy(*group).orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    ranked = placed.join(base, same, "left").withColumn(
        "_from", F.col("_base") + F.coalesce(F.sum("_n").over(within), F.lit(0)))
    at = lambda rank: F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_from") + F.col("_n"))
                                   & F.col("_v").isNotNull(), F.col("_v")))
    place = lambda q: F.lit(q) * (F.col("_all") - 1)
    found = ranked.groupBy(*labels, "observations", "_all").agg(
        *[at(kind(place(q))).alias(f"_{side}{i}") for i, q in enumerate(MARKS)
          for side, kind in (("lo", F.floor), ("hi", F.ceil))])
    between = lambda i, q: F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (place(q) - F.floor(place(q)))
    return found.select(*labels, "observations", *[
        between(i, q).alias(n) for i, (q, n) in enumerate(zip(MARKS, ("p50", "p95", "p99")))])


def histogram_states(observations: DataFrame, labels: list[str], value: str = "value", k: int = 800) -> DataFrame:
    """Per label set: how many observations, and a quantile sketch of the values
    as a column (`state`), to be stored per batch.  A rank is off by about 1 / k of the values,
    whatever their number; nulls have no rank.  A label that owns most rows is
    sketched map-side."""
    return observations.groupBy(*labels).agg(
        F.count("*").alias("observations"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("state"))


def merged_histogram(states: DataFrame, labels: list[str]) -> DataFrame:
    """Stored `histogram_states` of any batches as one histogram.  The states are
    merged, the observations aren't read again; labels without values have null marks."""
    out = states.groupBy(*labels).agg(F.sum("observations").alias("observations"), F.kll_merge_agg_double("state").alias("state"))
    some = F.kll_sketch_get_n_double("state") > 0
    return out.select(*labels, "observations", *[
        F.when(some, F.kll_sketch_get_quantile_double("state", F.lit(q))).alias(n)
        for q, n in zip(MARKS, ("p50", "p95", "p99"))])


def metrics_snapshot(observations: DataFrame, names: list[str]) -> DataFrame:
    """Named counter totals in one row; a metric never counted is 0."""
    return observations.agg(*[
        F.coalesce(F.sum(F.when(F.col("metric") == n, F.col("count"))), F.lit(0))
        .alias(f"{n}_total") for n in names])


def quota_report(answers: DataFrame) -> DataFrame:
    """Latest API quota per resource from response headers.  Headers that are
    not numbers make the answer count as carrying no quota."""
    as_long = lambda name: F.coalesce(F.col("headers")[name], F.lit("0")).try_cast("bigint")
    read = answers.select(
        F.coalesce(F.col("headers")["X-RateLimit-Resource"], F.lit("core")).alias("resource"),
        as_long("X-RateLimit-Limit").alias("limit"),
        as_long("X-RateLimit-Remaining").alias("remaining"),
        as_long("X-RateLimit-Used").alias("used"), "ts", "seq",
    ).where("limit is not null and remaining is not null and used is not null")
    last = read.groupBy("resource").agg(
        F.max_by(F.struct("limit", "remaining", "used"), F.struct("ts", "seq")).alias("q"))
    return (last.select("resource", "q.*")
            .withColumn("utilization_pct", F.when(F.col("limit") == 0, 0.0)
                        .otherwise(F.try_divide(F.col("used"), F.col("limit")) * 100))
            .withColumn("exhausted", F.col("remaining") == 0)
            .withColumn("low", F.col("remaining") < V.LOW_QUOTA))


def health_latest(log: DataFrame, suspended: DataFrame) -> DataFrame:
    """Last probe per instance, suspended instances left out.  The log is
    reduced before the anti join: one row per instance meets the list."""
    last = log.groupBy("instance_id").agg(
        F.max_by(F.struct("healthy", "latency_ms", "error"), F.struct("checked_at", "seq"))
        .alias("h"), F.max("checked_at").alias("checked_at"))
    return (last.join(suspended.select("instance_id"), "instance_id", "left_anti")
            .select("instance_id", "h.*", "checked_at"))
