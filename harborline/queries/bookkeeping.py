"""Repository, dead letters, events, jobs, sessions, metrics, positions,
retry and breaker reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import values as V
from harborline.functions.classify import health_class, http_error_type, retryable
from harborline.operators import aggregates as A, cursors as C, deadletter as DL, history as H
from harborline.operators import ordered as O, repository as R, resilience as X, validate
from harborline.operators.dedup import keep_first
from harborline.plans import batch, route
from harborline.queries import derive as D
from harborline.queries.registry import Tables, query
from harborline.session import materialize, shared_dir

# ---------------------------------------------------------------- repository


def entries(t: Tables):
    docs = keep_first(D.clean_documents(t), ["id"])
    ref = F.col("source_ref")
    return docs.select("seq", "id", ref["connector_id"].alias("connector_id"),
                       ref["instance_id"].alias("instance_id"), ref["uri"].alias("uri"),
                       "content", "content_type", "size_bytes", "workspace_id",
                       F.col("acquired_at").alias("created_at"))


def status_log(t: Tables):
    """Claims and outcomes, up to four rows per document."""
    d = D.clean_documents(t).select("seq", "id")
    step = lambda when, n, status, err: F.when(when, F.struct(
        F.lit(n).alias("n"), F.lit(status).alias("status"), F.lit(err).alias("error"),
        F.lit(f"worker-{n}").alias("processed_by")))
    k = F.col("seq")
    steps = F.array_compact(F.array(
        step(k % 7 != 0, 1, "PROCESSING", None), step(k % 3 == 0, 2, "FAILED", "boom"),
        step(k % 3 == 0, 3, "PROCESSING", None), step(k % 5 < 3, 4, "DONE", None)))
    return d.select("id", F.explode(steps).alias("s"), "seq").select(
        "id", "s.status", "s.error", "s.processed_by",
        (F.col("seq") * 4 + F.col("s.n")).alias("log_seq"),
        D.at(F.col("seq") * 10 + F.col("s.n")).alias("updated_at"))


ENTRIES_SQL = D.CLEAN_SQL + """,
entries AS (SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1)"""
LOG_SQL = ENTRIES_SQL + """,
log AS (
  SELECT id, s.status, s.error, 'worker-' || s.n AS processed_by, seq * 4 + s.n AS log_seq,
    TIMESTAMP '2024-01-01' + to_seconds(seq * 10 + s.n) AS updated_at
  FROM clean, (VALUES (1, 'PROCESSING', NULL), (2, 'FAILED', 'boom'), (3, 'PROCESSING', NULL),
    (4, 'DONE', NULL)) s(n, status, error)
  WHERE (s.n = 1 AND seq % 7 <> 0) OR (s.n IN (2, 3) AND seq % 3 = 0) OR (s.n = 4 AND seq % 5 < 3)),
state AS (
  SELECT id, max_by(status, log_seq) AS status, count(*) FILTER (status = 'PROCESSING') AS attempts,
    max_by(error, log_seq) FILTER (error IS NOT NULL) AS processing_error,
    max_by(processed_by, log_seq) AS processed_by, max(updated_at) AS updated_at
  FROM log GROUP BY id),
current AS (
  SELECT e.*, coalesce(s.status, 'PENDING') AS status, coalesce(s.attempts, 0) AS attempts,
    s.processing_error, s.processed_by, coalesce(s.updated_at, e.acquired_at) AS updated_at
  FROM entries e LEFT JOIN state s USING (id))"""


@query("repo_write", f"""WITH {D.CLEAN_SQL}{D.STORED_SQL}
SELECT seq, id, 'PENDING' AS status FROM clean WHERE id NOT IN (SELECT id FROM stored)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1""")
def repo_write(t: Tables):
    added = R.insert_absent(D.clean_documents(t), D.stored_ids(t))
    return added.select("seq", "id", F.lit("PENDING").alias("status"))


@query("repo_read", f"""WITH {LOG_SQL}
SELECT id, uri, content_type, size_bytes, status, attempts FROM current
WHERE id = (SELECT min(id) FROM entries)""")
def repo_read(t: Tables):
    stored = entries(t)
    wanted = stored.agg(F.min("id")).first()[0]
    return R.read_one(R.current_status(stored.where(F.col("id") == wanted), status_log(t)),
                      wanted).select("id", "uri", "content_type", "size_bytes", "status", "attempts")


@query("repo_exists", f"""WITH {D.CLEAN_SQL}{D.STORED_SQL}
SELECT seq, id FROM clean WHERE id IN (SELECT id FROM stored)""")
def repo_exists(t: Tables):
    return R.exists(D.clean_documents(t).select("seq", "id"), D.stored_ids(t)).select("seq", "id")


_FILTER = R.Filters(status="DONE", content_type="text/plain", since="2024-01-01 00:01:00",
                    until="2024-01-01 02:00:00", limit=60, offset=10)
_FILTER_SQL = """status = 'DONE' AND content_type = 'text/plain'
  AND acquired_at >= TIMESTAMP '2024-01-01 00:01:00' AND acquired_at <= TIMESTAMP '2024-01-01 02:00:00'"""


@query("repo_query", f"""WITH {LOG_SQL} SELECT id, uri, status, acquired_at AS created_at
FROM current WHERE {_FILTER_SQL} ORDER BY acquired_at, id LIMIT 60 OFFSET 10""")
def repo_query(t: Tables):
    current = R.current_status(entries(t).drop("content"), status_log(t))
    return R.query(current, _FILTER).select("id", "uri", "status", "created_at")


@query("repo_count", f"WITH {LOG_SQL} SELECT count(*) AS documents FROM current WHERE {_FILTER_SQL}")
def repo_count(t: Tables):
    return R.count(R.current_status(entries(t).drop("content"), status_log(t)), _FILTER)


@query("repo_update_status", f"""WITH {ENTRIES_SQL}{D.STORED_SQL}
SELECT id, 'FAILED' AS status, 'bad parse' AS error, 'transform' AS processed_by FROM entries
WHERE content_type = 'application/json' AND id IN (SELECT id FROM stored)""")
def repo_update_status(t: Tables):
    wanted = entries(t).where("content_type = 'application/json'").select("id")
    return R.status_change(R.exists(wanted, D.stored_ids(t)), "FAILED", "bad parse", "transform") \
        .drop("updated_at")


@query("repo_current_status", f"""WITH {LOG_SQL}
SELECT id, status, attempts, processing_error, processed_by, updated_at FROM current""")
def repo_current_status(t: Tables):
    return R.current_status(entries(t).select("id", "created_at"), status_log(t)).select(
        "id", "status", "attempts", "processing_error", "processed_by", "updated_at")


def routed(t: Tables):
    return route.route(D.landed_documents(t), rule=validate.default_rules(D.MAX_BYTES))


@query("sink_events", f"""WITH {D.ROUTED_SQL}, e AS (SELECT *, CASE status
    WHEN 'done' THEN 'RawDocumentCreated' WHEN 'skipped' THEN 'DocumentDeduplicated'
    ELSE 'AcquisitionFailed' END AS event_type FROM routed)
SELECT sha256('7:' || seq || ':' || event_type) AS event_id, event_type, id AS document_id,
  connector_id, instance_id, uri,
  CASE WHEN status = 'failed' THEN message END AS error_message,
  CASE WHEN status = 'done' THEN size_bytes END AS size_bytes FROM e""")
def sink_events(t: Tables):
    detail = lambda f: F.get_json_object("detail", f"$.{f}")
    return batch.events(routed(t), F.lit(7)).select(
        "event_id", "event_type", "document_id", "connector_id", "instance_id", "uri",
        detail("error_message").alias("error_message"),
        detail("size_bytes").cast("bigint").alias("size_bytes"))


# -------------------------------------------------------------- dead letters


def dead_letters(t: Tables):
    rows = route.thin(D.landed_documents(t), validate.default_rules(D.MAX_BYTES))
    return DL.enqueue(rows, batch=F.lit("b1"), failed_at=D.at(F.col("seq") * 3))


def dismissals(entries):
    return DL.dismissal(entries.where(F.col("seq") % 4 == 3), "known", D.at(F.col("seq")))


def settled(t: Tables):
    """The dead-letter table, as stored, with its dismissals."""
    kept = materialize(dead_letters(t), "dlq")
    return DL.with_dismissals(kept, dismissals(kept))


DLQ_SQL = D.CHECKED_SQL + """,
dlq AS (
  SELECT sha256('b1:' || seq) AS entry_id, id AS document_id, 'VALIDATION' AS failure_type,
    error_type, message AS error_message, connector_id, instance_id, seq, 1 AS attempt_count,
    TIMESTAMP '2024-01-01' + to_seconds(seq * 3) AS failed_at, seq % 4 = 3 AS dismissed
  FROM worded WHERE error_type IS NOT NULL)"""


@query("dlq_enqueue", f"""WITH {DLQ_SQL} SELECT entry_id, document_id, failure_type, error_type,
  error_message, connector_id, instance_id, attempt_count, failed_at FROM dlq""")
def dlq_enqueue(t: Tables):
    return dead_letters(t).drop("seq", "uri")


@query("dlq_get", f"""WITH {DLQ_SQL} SELECT entry_id, document_id, error_type FROM dlq
WHERE entry_id = (SELECT max(entry_id) FROM dlq)""")
def dlq_get(t: Tables):
    kept = materialize(dead_letters(t), "dlq")
    return DL.get(kept, kept.agg(F.max("entry_id")).first()[0]).select("entry_id", "document_id", "error_type")


@query("dlq_dismiss", f"""WITH {DLQ_SQL} SELECT entry_id, dismissed,
  CASE WHEN dismissed THEN 'known' END AS dismiss_reason FROM dlq""")
def dlq_dismiss(t: Tables):
    return settled(t).select(
        "entry_id", "dismissed", "dismiss_reason")


@query("srt_dlq_list", f"""WITH {DLQ_SQL} SELECT entry_id, failed_at, error_type FROM dlq
WHERE NOT dismissed AND connector_id = 'c1' AND failed_at >= TIMESTAMP '2024-01-01 00:05:00'
ORDER BY failed_at, entry_id LIMIT 100""")
def srt_dlq_list(t: Tables):
    full = settled(t)
    return DL.listing(full, DL.DeadLetterFilters(
        connector_id="c1", since="2024-01-01 00:05:00")).select("entry_id", "failed_at", "error_type")


@query("agg_dlq_stats", f"""WITH {DLQ_SQL} SELECT failure_type, connector_id, count(*) AS entries,
  min(failed_at) AS oldest FROM dlq WHERE NOT dismissed
GROUP BY GROUPING SETS ((failure_type), (connector_id), ())""")
def agg_dlq_stats(t: Tables):
    return DL.stats(settled(t))


@query("agg_dlq_size", f"WITH {DLQ_SQL} SELECT count(*) AS active FROM dlq WHERE NOT dismissed")
def agg_dlq_size(t: Tables):
    return DL.size(settled(t))


@query("dlq_replay", f"""WITH {DLQ_SQL}, again AS (
  SELECT w.*, CASE WHEN w.error_type = 'SizeLimitError' THEN NULL ELSE w.error_type END AS err
  FROM worded w JOIN dlq USING (seq) WHERE NOT dismissed)
SELECT seq, 2 AS attempt_count, CASE WHEN err IS NOT NULL THEN 'failed'
  WHEN seq = min(seq) FILTER (WHERE err IS NULL) OVER (PARTITION BY id) THEN 'done'
  ELSE 'skipped' END AS status FROM again""")
def dlq_replay(t: Tables):
    docs = D.landed_documents(t)
    failed = validate.validated(docs, validate.default_rules(D.MAX_BYTES)) \
        .where("error is not null").select(
            "*", *[F.col("source_ref")[c].alias(c) for c in ("connector_id", "instance_id", "uri")])
    kept = DL.enqueue(failed, batch=F.lit("b1"),
                      document=[c for c in docs.columns if c != "seq"])
    none = D.stored_ids(t).limit(0)
    # The size limit has been raised since: those documents pass now.
    return batch.replay(kept, dismissals(dead_letters(t)), none, validate.default_rules()).select(
        "seq", "attempt_count", "status")


# ---------------------------------------------------------- jobs and sessions


def outcomes(t: Tables):
    kind = F.col("event_type")
    return t.events.select(
        "event_id", "ts", F.col("user_id").cast("string").alias("session_id"),
        F.concat_ws("-", "user_id", F.floor(F.col("event_id") / 1000).cast("string")).alias("job_id"),
        F.when(kind == "error", "failed").when(kind == "signup", "skipped")
        .otherwise("done").alias("status"))


def jobs(t: Tables):
    n = lambda s: F.count_if(F.col("status") == s)
    g = outcomes(t).groupBy("session_id", "job_id").agg(
        n("done").alias("documents_acquired"), n("failed").alias("documents_failed"),
        F.count("*").alias("n"), F.min("ts").alias("started_at"), F.max("ts").alias("ended"),
        F.max("event_id").alias("last"))
    status = (F.when(F.col("documents_failed") >= 2, "FAILED").when(F.col("n") == 1, "RUNNING")
              .otherwise("COMPLETED"))
    return g.select("session_id", "job_id", "documents_acquired", "documents_failed", "started_at",
                    F.when(F.col("n") > 1, F.col("ended")).alias("completed_at"),
                    status.alias("status"),
                    F.concat(F.lit("p"), F.col("last").cast("string")).alias("final_cursor_value"))


JOBS_SQL = """
outcomes AS (
  SELECT event_id, ts, user_id::VARCHAR AS session_id, user_id || '-' || (event_id // 1000) AS job_id,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' ELSE 'done' END AS status
  FROM events),
jobs AS (
  SELECT session_id, job_id, count(*) FILTER (status = 'done') AS documents_acquired,
    count(*) FILTER (status = 'failed') AS documents_failed, min(ts) AS started_at,
    CASE WHEN count(*) > 1 THEN max(ts) END AS completed_at,
    CASE WHEN count(*) FILTER (status = 'failed') >= 2 THEN 'FAILED' WHEN count(*) = 1 THEN 'RUNNING'
      ELSE 'COMPLETED' END AS status, 'p' || max(event_id) AS final_cursor_value
  FROM outcomes GROUP BY ALL)"""


@query("agg_job_counters", f"""WITH {JOBS_SQL}, c AS (SELECT job_id,
  count(*) FILTER (status = 'done') AS acquired, count(*) FILTER (status = 'skipped') AS skipped,
  count(*) FILTER (status = 'failed') AS failed, count(*) AS total FROM outcomes GROUP BY job_id)
SELECT *, acquired / total AS success_rate FROM c""")
def agg_job_counters(t: Tables):
    return A.job_counters(outcomes(t))


@query("agg_job_duration", f"""WITH {JOBS_SQL} SELECT job_id, status,
  (epoch_us(completed_at) - epoch_us(started_at)) / 1000.0::DOUBLE AS duration_ms,
  status IN ('COMPLETED', 'FAILED', 'CANCELLED') AS terminal FROM jobs""")
def agg_job_duration(t: Tables):
    return A.job_duration(jobs(t)).select("job_id", "status", "duration_ms", "terminal")


@query("agg_session_totals", f"""WITH {JOBS_SQL} SELECT session_id, count(*) AS total_jobs,
  count(*) FILTER (status = 'COMPLETED') AS successful_jobs,
  count(*) FILTER (status = 'FAILED') AS failed_jobs,
  sum(documents_acquired)::BIGINT AS documents_acquired,
  sum(documents_failed)::BIGINT AS documents_failed FROM jobs GROUP BY session_id""")
def agg_session_totals(t: Tables):
    return A.session_totals(jobs(t))


@query("agg_session_liveness", """SELECT user_id AS session_id, max(ts) AS last_heartbeat,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS uptime_s FROM events GROUP BY user_id""")
def agg_session_liveness(t: Tables):
    return A.session_liveness(t.events.select(F.col("user_id").alias("session_id"), "ts"))


@query("cur_session_max", f"""WITH {JOBS_SQL} SELECT session_id, max(final_cursor_value) AS last_cursor
FROM jobs WHERE status = 'COMPLETED' GROUP BY session_id""")
def cur_session_max(t: Tables):
    return C.session_position(jobs(t))


_STATUS_OF = {"view": "PENDING", "click": "RUNNING", "purchase": "COMPLETED", "error": "FAILED",
              "signup": "CANCELLED"}


@query("win_job_transitions", f"""WITH m AS (SELECT event_id AS seq, user_id AS job_id,
  CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _STATUS_OF.items())} END AS status FROM events),
p AS (SELECT *, lag(status) OVER (PARTITION BY job_id ORDER BY seq) AS previous_status FROM m)
SELECT seq, job_id, previous_status, status, (previous_status, status) IN (
  {', '.join(str(m) for m in V.JOB_MOVES)}) AS legal FROM p WHERE previous_status IS NOT NULL""")
def win_job_transitions(t: Tables):
    status = F.element_at(F.create_map(*[F.lit(x) for kv in _STATUS_OF.items() for x in kv]),
                          F.col("event_type"))
    log = t.events.select(F.col("event_id").alias("seq"), F.col("user_id").alias("job_id"),
                          status.alias("status"))
    return H.job_transitions(log, chunk=O.seq_chunk("seq", 5000)).select(
        "seq", "job_id", "previous_status", "status", "legal")


# ------------------------------------------------------------ health, metrics


def health_log(t: Tables):
    bad = F.col("event_type") == "error"
    return t.events.select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("instance_id"),
        (~bad).alias("healthy"), F.when(~bad, F.col("value") * 10).alias("latency_ms"),
        F.when(bad, F.col("props")).alias("error"), F.col("ts").alias("checked_at"))


HEALTH_SQL = """health AS (SELECT event_id AS seq, user_id AS instance_id,
  event_type <> 'error' AS healthy, CASE WHEN event_type <> 'error' THEN value * 10 END AS latency_ms,
  CASE WHEN event_type = 'error' THEN props END AS error, ts AS checked_at FROM events)"""


@query("win_health_changes", f"""WITH {HEALTH_SQL}, p AS (SELECT *,
  lag(healthy) OVER (PARTITION BY instance_id ORDER BY seq) AS was_healthy FROM health)
SELECT seq, instance_id, healthy, was_healthy FROM p WHERE was_healthy <> healthy""")
def win_health_changes(t: Tables):
    return H.health_changes(health_log(t), chunk=O.seq_chunk("seq", 5000)).select(
        "seq", "instance_id", "healthy", "was_healthy")


@query("agg_health_latest", f"""WITH {HEALTH_SQL} SELECT instance_id,
  arg_max(healthy, seq) AS healthy, max_by({{'v': latency_ms}}, seq).v AS latency_ms,
  max_by({{'v': error}}, seq).v AS error, max(checked_at) AS checked_at FROM health
WHERE instance_id % 10 <> 0 GROUP BY instance_id""")
def agg_health_latest(t: Tables):
    log = health_log(t)
    suspended = log.where(F.col("instance_id") % 10 == 0).select("instance_id").distinct()
    return A.health_latest(log, suspended)


@query("fn_health_class", f"""WITH {HEALTH_SQL} SELECT seq, CASE WHEN NOT healthy THEN 'UNHEALTHY'
  WHEN latency_ms > 500 THEN 'DEGRADED' ELSE 'HEALTHY' END AS class FROM health""")
def fn_health_class(t: Tables):
    return health_log(t).select("seq", health_class(F.col("healthy"), F.col("latency_ms"))
                                .alias("class"))


@query("agg_counter_by_labels", """SELECT event_type, shard, count(*) AS value,
  grouping(event_type) = 1 AS is_total FROM (SELECT event_type, user_id % 7 AS shard FROM events)
GROUP BY GROUPING SETS ((event_type, shard), ())""")
def agg_counter_by_labels(t: Tables):
    seen = t.events.select("event_type", (F.col("user_id") % 7).alias("shard"),
                           F.lit(1).alias("count"))
    return A.counter_by_labels(seen, ["event_type", "shard"])


@query("agg_histogram", """SELECT event_type, count(*) AS observations,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
  round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type""")
def agg_histogram(t: Tables):
    h = A.histogram(t.events.select("event_type", "value"), ["event_type"])
    return h.select("event_type", "observations",
                    *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


@query("agg_histogram_states", """SELECT event_type, count(*) AS observations, true AS ok50, true AS ok95, true AS ok99
FROM events GROUP BY event_type""")
def agg_histogram_states(t: Tables):
    """Seven batches leave a state each; the marks of all of them must have ranks
    within one per cent of those asked for."""
    path = shared_dir(t.spark, "histogram")
    batches = t.events.withColumn("batch_id", F.col("event_id") % 7)
    A.histogram_states(batches, ["batch_id", "event_type"]).write.partitionBy("batch_id").parquet(path)
    marks = A.merged_histogram(t.spark.read.parquet(path), ["event_type"])
    rank = lambda c: F.count_if(F.col("value") <= F.col(c)) / F.count("value")
    below = lambda c: F.count_if(F.col("value") < F.col(c)) / F.count("value")
    seen = t.events.join(marks, "event_type").groupBy("event_type", "observations").agg(
        *[((below(c) <= q + 0.01) & (rank(c) >= q - 0.01)).alias(f"ok{c[1:]}") for c, q in zip(("p50", "p95", "p99"), A.MARKS)])
    return seen


_METRIC_OF = {"view": "documents_acquired", "click": "documents_skipped",
              "error": "documents_failed", "signup": "retry_attempts", "purchase": "jobs_completed"}


@query("agg_metrics_snapshot", "SELECT " + ", ".join(
    f"count(*) FILTER (event_type = '{k}') AS {v}_total" for k, v in _METRIC_OF.items())
    + ", 0::BIGINT AS dlq_enqueued_total, 0::BIGINT AS jobs_failed_total FROM events")
def agg_metrics_snapshot(t: Tables):
    name = F.element_at(F.create_map(*[F.lit(x) for kv in _METRIC_OF.items() for x in kv]),
                        F.col("event_type"))
    seen = t.events.select(name.alias("metric"), F.lit(1).alias("count"))
    out = A.metrics_snapshot(seen, [*_METRIC_OF.values(), "dlq_enqueued", "jobs_failed"])
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in out.columns])


@query("agg_quota_report", """WITH h AS (SELECT event_id, ts,
  CASE WHEN event_type = 'view' THEN 'core' ELSE event_type END AS resource,
  CASE WHEN event_type = 'signup' THEN 0 ELSE 5000 END AS "limit", event_id % 5000 AS remaining,
  5000 - event_id % 5000 AS used FROM events WHERE event_id % 97 <> 0),
q AS (SELECT resource, max_by("limit", event_id)::BIGINT AS "limit",
  max_by(remaining, event_id) AS remaining, max_by(used, event_id) AS used FROM h GROUP BY resource)
SELECT *, CASE WHEN "limit" = 0 THEN 0.0::DOUBLE ELSE used / "limit" * 100 END AS utilization_pct,
  remaining = 0 AS exhausted, remaining < 100 AS low FROM q""")
def agg_quota_report(t: Tables):
    e = F.col("event_id")
    s = lambda c: c.cast("string")
    headers = F.map_filter(F.create_map(
        F.lit("X-RateLimit-Limit"), F.when(F.col("event_type") == "signup", "0").otherwise("5000"),
        F.lit("X-RateLimit-Remaining"), F.when(e % 97 == 0, "n/a").otherwise(s(e % 5000)),
        F.lit("X-RateLimit-Used"), s(5000 - e % 5000),
        F.lit("X-RateLimit-Resource"), F.when(F.col("event_type") != "view", F.col("event_type"))),
        lambda k, v: v.isNotNull())
    return A.quota_report(t.events.select("ts", e.alias("seq"), headers.alias("headers")))


# ------------------------------------------------------------------ positions


@query("cur_delta_filter", """
SELECT 's3' AS rule, o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'
UNION ALL SELECT 'prs', o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
UNION ALL SELECT 'releases', o_orderkey FROM orders WHERE o_orderkey > 7000
UNION ALL SELECT 'none', o_orderkey FROM orders""")
def cur_delta_filter(t: Tables):
    o = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
                        .alias("day"))
    pick = lambda name, p: o.where(p).select(F.lit(name).alias("rule"), "o_orderkey")
    return (pick("s3", C.delta(F.col("day"), "2000-01-01T00:00:00", "s3"))
            .unionByName(pick("prs", C.delta(F.col("day"), "2000-01-01T00:00:00", "prs")))
            .unionByName(pick("releases", C.delta(F.col("o_orderkey"), 7000, "releases")))
            .unionByName(pick("none", C.delta(F.col("day"), None))))


@query("cur_parse_composite", """SELECT event_id,
  CASE WHEN event_id % 10 = 0 THEN 0 ELSE 2 END AS n_keys,
  CASE WHEN event_id % 10 <> 0 THEN event_id::VARCHAR END AS position FROM events""")
def cur_parse_composite(t: Tables):
    good = F.to_json(F.create_map(F.concat(F.lit("issues:"), "user_id"), F.col("event_id").cast("string"),
                                  F.lit("prs:x"), F.col("event_type")))
    value = F.when(F.col("event_id") % 10 == 0, F.lit("not json")).otherwise(good)
    m = C.parse_composite(value)
    return t.events.select("event_id", F.size(m).alias("n_keys"),
                           F.try_element_at(m, F.concat(F.lit("issues:"), "user_id")).alias("position"))


@query("cur_make_composite", """SELECT event_id, '{"a:' || event_type || '":"' || event_id ||
  '","z:' || user_id || '":"' || event_type || '"}' AS composite FROM events""")
def cur_make_composite(t: Tables):
    m = F.create_map(F.concat(F.lit("z:"), "user_id"), F.col("event_type"),
                     F.concat(F.lit("a:"), "event_type"), F.col("event_id").cast("string"))
    return t.events.select("event_id", C.make_composite(m).alias("composite"))


_KINDS = sorted(_STATUS_OF)


@query("cur_stamp_running", f"""WITH e AS (SELECT event_id AS seq, user_id % 20 AS instance_id, event_type,
  CASE WHEN event_id % 11 <> 0 THEN event_id END AS position FROM events),
w AS (SELECT seq, instance_id, {', '.join(
    f"last_value(CASE WHEN event_type = '{k}' THEN position END IGNORE NULLS) OVER r AS {k}" for k in _KINDS)}
  FROM e WINDOW r AS (PARTITION BY instance_id ORDER BY seq ROWS UNBOUNDED PRECEDING))
SELECT seq, instance_id, '{{' || concat_ws(',', {', '.join(
    f"""'"{k}":"' || {k} || '"'""" for k in _KINDS)}) || '}}' AS composite FROM w""")
def cur_stamp_running(t: Tables):
    rows = t.events.select(
        F.col("event_id").alias("seq"), (F.col("user_id") % 20).alias("instance_id"),
        F.col("event_type").alias("cursor_key"),
        F.when(F.col("event_id") % 11 != 0, F.col("event_id").cast("string")).alias("position"))
    return C.stamp_running(rows).select("seq", "instance_id", "composite")


@query("cur_advance_done", f"""WITH {D.ROUTED_SQL}
SELECT connector_id, instance_id, max(seq)::VARCHAR AS value, 'sequence' AS source_type
FROM routed WHERE status = 'done' GROUP BY ALL""")
def cur_advance_done(t: Tables):
    return C.advance_done(routed(t))


@query("cur_snapshot_unchanged", """SELECT doc_id, source || '/' || doc_id AS repo, md5(text) AS tree_sha
FROM documents WHERE doc_id % 3 <> 0""")
def cur_snapshot_unchanged(t: Tables):
    now = t.documents.select("doc_id", F.concat_ws("/", "source", "doc_id").alias("repo"),
                             F.md5(F.encode("text", "UTF-8")).alias("tree_sha"))
    then = t.documents.select(
        F.concat_ws("/", "source", "doc_id").alias("repo"),
        F.when(F.col("doc_id") % 3 == 0, F.md5(F.encode("text", "UTF-8"))).otherwise("old")
        .alias("tree_sha"))
    return C.unchanged_snapshots(now, then).select("doc_id", "repo", "tree_sha")


@query("jn_cursor_lookup", """WITH s AS (SELECT o_orderpriority AS k, max(o_orderdate) AS since FROM orders
  WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1998-06-01' GROUP BY 1)
SELECT o_orderkey, k AS cursor_key FROM orders JOIN s ON k = o_orderpriority
WHERE o_orderdate > since""")
def jn_cursor_lookup(t: Tables):
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    o = t.orders.select(F.lit("i1").alias("instance_id"), "o_orderkey", "o_orderpriority",
                        "o_orderstatus", day.alias("day"))
    stored = (o.where("o_orderstatus = 'F' and day < '1998-06-01'")
              .groupBy("instance_id", F.col("o_orderpriority").alias("cursor_key"))
              .agg(F.max("day").alias("value")))
    return C.lookup(o, stored, F.col("o_orderpriority"), "day").select("o_orderkey", "cursor_key")


# ------------------------------------------------------------- limits, unions


@query("win_limit_per_key", """SELECT event_id, user_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 5""")
def win_limit_per_key(t: Tables):
    return O.limit_per_key(t.events.select("event_id", "user_id"), ["user_id"], ["event_id"], 5)


@query("lim_batch", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 100")
def lim_batch(t: Tables):
    return O.limit_batch(t.events.select("event_id", "ts"), [F.desc("ts"), "event_id"], 100)


@query("set_union_resources", """
SELECT 'customer://' || c_custkey AS uri, 'customers' AS resource_type, 0 AS resource_rank FROM customer
UNION ALL SELECT 'part://' || p_partkey, 'parts', 1 FROM part
UNION ALL SELECT 'order://' || o_orderkey, 'orders', 2 FROM orders""")
def set_union_resources(t: Tables):
    uri = lambda df, scheme, key: df.select(F.concat(F.lit(f"{scheme}://"), key).alias("uri"))
    return O.union_resources([("customers", uri(t.customer, "customer", "c_custkey")),
                              ("parts", uri(t.part, "part", "p_partkey")),
                              ("orders", uri(t.orders, "order", "o_orderkey"))])


# ----------------------------------------------------------------- resilience

_ERRORS = {"error": "ConnectorNetworkError", "signup": "ConnectorRateLimitError",
           "view": "ConnectorTimeoutError", "click": "ConnectorAuthenticationError"}


@query("retry_due", f"""WITH f AS (SELECT event_id AS seq, ts, user_id || '-' || (event_id // 2000) AS op_id,
  CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _ERRORS.items())} END AS error_type,
  CASE WHEN event_id % 2 = 0 THEN (event_id % 90)::DOUBLE END AS retry_after_s,
  (['AGGRESSIVE', 'STANDARD', 'CONSERVATIVE', 'NO_RETRY'])[(user_id % 4)::INT + 1] AS policy
  FROM events WHERE event_type <> 'purchase'),
p(policy, n, first_ms, max_ms, mult) AS (VALUES {', '.join(
    f"('{k}', {a}, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE)" for k, (a, b, c, d) in V.RETRY_POLICIES.items())}),
c AS (SELECT f.*, p.*, row_number() OVER w AS attempt,
  coalesce(count(*) FILTER (error_type <> 'ConnectorRateLimitError')
    OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k
  FROM f JOIN p USING (policy) WINDOW w AS (PARTITION BY op_id ORDER BY seq)),
x AS (SELECT *, error_type = 'ConnectorAuthenticationError' AS fatal,
  error_type <> 'ConnectorAuthenticationError' AND attempt >= n AS exhausted FROM c),
z AS (SELECT *, CASE WHEN fatal OR exhausted THEN NULL
  WHEN error_type = 'ConnectorRateLimitError' AND retry_after_s IS NOT NULL THEN retry_after_s * 1000
  ELSE least(first_ms * pow(mult, k), max_ms) END AS wait_ms FROM x)
SELECT seq, op_id, attempt, fatal, exhausted, wait_ms,
  make_timestamp(epoch_us(ts) + round(wait_ms * 1000)::BIGINT) AS next_attempt_at FROM z""")
def retry_due(t: Tables):
    e = F.col("event_id")
    error = F.element_at(F.create_map(*[F.lit(x) for kv in _ERRORS.items() for x in kv]),
                         F.col("event_type"))
    fails = t.events.where("event_type <> 'purchase'").select(
        e.alias("seq"), "ts", F.concat_ws("-", "user_id", F.floor(e / 2000).cast("string")).alias("op_id"),
        error.alias("error_type"),
        F.when(e % 2 == 0, (e % 90).cast("double")).alias("retry_after_s"),
        F.element_at(F.array(*map(F.lit, V.RETRY_POLICIES)), (F.col("user_id") % 4 + 1).cast("int"))
        .alias("policy"))
    return X.retry_due(fails).select("seq", "op_id", "attempt", "fatal", "exhausted", "wait_ms",
                                     "next_attempt_at")


def calls(t: Tables):
    """Ten busy resources, failing more often than not."""
    return t.events.select((F.col("user_id") % 10).alias("resource_id"),
                           F.col("event_id").alias("seq"), "ts",
                           F.col("event_type").isin("view", "purchase").alias("ok"))


@query("res_circuit_state", """WITH c AS (SELECT user_id % 10 AS resource_id, event_id AS seq,
  event_type IN ('view', 'purchase') AS ok FROM events),
n AS (SELECT *, row_number() OVER w AS k,
  coalesce(max(CASE WHEN ok THEN event_no END) OVER w, 0) AS good
  FROM (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY seq) AS event_no FROM c)
  WINDOW w AS (PARTITION BY resource_id ORDER BY seq))
SELECT resource_id, seq, ok, (k - good)::BIGINT AS failure_run, k - good >= 5 AS tripped FROM n""")
def res_circuit_state(t: Tables):
    return X.failure_runs(calls(t), chunk=O.seq_chunk("seq", 5000)).select(
        "resource_id", "seq", "ok", "failure_run", "tripped")


_STATUSES = (200, 401, 403, 404, 422, 429, 500, 503, 418)


@query("fn_error_class", f"""WITH a AS (SELECT event_id,
  ({list(_STATUSES)})[(event_id % 9)::INT + 1] AS status,
  CASE WHEN user_id % 2 = 0 THEN 'API Rate Limit exceeded' ELSE props END AS body FROM events),
k AS (SELECT event_id, CASE WHEN status = 401 THEN 'ConnectorAuthenticationError'
  WHEN status = 403 AND contains(lower(body), 'rate limit') THEN 'ConnectorRateLimitError'
  WHEN status = 403 THEN 'ConnectorAuthenticationError' WHEN status = 404 THEN 'ResourceNotFoundError'
  WHEN status = 422 THEN 'ConnectorFatalError' WHEN status = 429 THEN 'ConnectorRateLimitError'
  WHEN status IN (500, 503) THEN 'ConnectorTemporaryError' ELSE 'ConnectorNetworkError' END AS error_type
  FROM a WHERE status <> 200)
SELECT *, error_type IN ('ConnectorRateLimitError', 'ConnectorTemporaryError', 'ConnectorNetworkError')
  AS retryable FROM k""")
def fn_error_class(t: Tables):
    status = F.element_at(F.array(*map(F.lit, _STATUSES)), (F.col("event_id") % 9 + 1).cast("int"))
    body = F.when(F.col("user_id") % 2 == 0, "API Rate Limit exceeded").otherwise(F.col("props"))
    rows = t.events.select("event_id", status.alias("status"), body.alias("body")).where("status <> 200")
    kind = http_error_type(F.col("status"), F.col("body"))
    return rows.select("event_id", kind.alias("error_type")).withColumn(
        "retryable", retryable(F.col("error_type")))
