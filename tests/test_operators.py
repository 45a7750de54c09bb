import json
import random

import pytest

from pyspark.sql import functions as F

from harborline.catalog import values as V
from harborline.operators.envelope import envelope
from harborline.operators import (aggregates, cursors, deadletter as DL, dedup, history, joins, ordered,
                                  repository as R, resilience as X, validate)
from harborline.operators.envelope import envelope, with_integrity
from harborline.plans import batch, route


def test_envelope_fields(docs):
    row = docs.where("seq = 0").first()
    assert len(row.id) == 64 and row.size_bytes == 6 and row.source_ref.uri.endswith("/0")
    assert row.cursor.value == "0" and row.tags == ["t"] and row.source_metadata == "{}"
    assert docs.where("seq = 3").first().id == row.id
    assert with_integrity(docs).where("intact").count() == 5


def defect(docs, **changes):
    out = docs.where("seq = 0")
    for name, expr in changes.items():
        out = out.withColumn(name, expr)
    found = validate.validated(out, validate.default_rules(100)).first().error
    return found and (found.error_type, found.error_field)


def test_each_defect_has_its_error(docs):
    lit = F.lit
    assert defect(docs) is None
    assert defect(docs, id=lit("")) == ("MissingRequiredFieldError", "id")
    assert defect(docs, id=lit("short")) == ("SchemaValidationError", "id")
    assert defect(docs, content_type=lit("")) == ("MissingRequiredFieldError", "content_type")
    assert defect(docs, acquired_at=lit(None).cast("timestamp")) == ("MissingRequiredFieldError", "acquired_at")
    assert defect(docs, content=lit(b"")) == ("EmptyContentError", None)
    assert defect(docs, size_bytes=lit(101)) == ("SizeLimitError", None)
    assert defect(docs, checksum=lit("0")) == ("ChecksumMismatchError", None)
    # The first failing rule decides.
    assert defect(docs, id=lit("short"), content=lit(b"")) == ("SchemaValidationError", "id")


def test_mime_rule(docs):
    check = lambda allowed: validate.validated(docs, validate.mime_rule(allowed)).where(
        "error is not null").count()
    assert (check(None), check(["*/*"]), check(["text/*"]), check(["text/plain"]), check(["image/*"])) == (
        0, 0, 0, 0, 5)


def test_first_valid_document_wins(docs):
    bad_first = docs.withColumn("content", F.when(F.col("seq") == 0, F.lit(b"")).otherwise(F.col("content")))
    out = {r.seq: r.status for r in route.route(bad_first).collect()}
    assert out == {0: "failed", 1: "done", 2: "done", 3: "done", 4: "done"}
    out = {r.seq: (r.status, r.reason) for r in route.route(docs).collect()}
    assert out[3] == ("skipped", "duplicate") and out[0] == ("done", "")


def test_known_ids_and_version_key(docs):
    known = docs.where("seq = 1").select("id")
    assert {r.seq for r in route.route(docs, known).where("status = 'done'").collect()} == {0, 2, 4}
    versions = docs.withColumn("source_ref", F.col("source_ref").withField(
        "version", F.col("seq").cast("string")))
    assert route.route(versions, key=["id", "version"]).where("status = 'done'").count() == 5


def test_one_key_holding_most_rows(spark):
    rows = spark.range(30_000).select(F.col("id").alias("seq"),
                                      F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("id"))
    kept = dedup.keep_first(rows, ["id"])
    assert kept.count() == 10_001 and kept.where("id = 'hot'").first().seq == 1
    assert "Window" not in kept._jdf.queryExecution().executedPlan().toString()


def brute_running(rows, inclusive):
    out, last, total = {}, {}, {}
    for seq, g, v in sorted(rows):
        if inclusive:
            last[g] = v if v is not None else last.get(g)
            total[g] = total.get(g, 0) + (v or 0)
        out[seq] = (last.get(g), total.get(g, 0))
        if not inclusive:
            last[g] = v if v is not None else last.get(g)
            total[g] = total.get(g, 0) + (v or 0)
    return out


def test_running_values_over_chunks(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.6 else rng.choice("ab"), rng.choice([None, 1, 2, 5])) for i in range(900)]
    df = spark.createDataFrame(rows, "seq long, g string, v long")
    for inclusive in (True, False):
        got = ordered.running(df, ["g"], "seq", {"l": ("last", F.col("v")), "s": ("sum", F.col("v"))},
                              inclusive=inclusive, chunk=ordered.seq_chunk("seq", 37)).collect()
        assert {r.seq: (r.l, r.s) for r in got} == brute_running(rows, inclusive)


def test_stamped_positions(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("xyy"), f"k{rng.randrange(4)}", rng.choice([None, str(i)])) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, instance_id string, cursor_key string, position string")
    state, want = {}, {}
    for seq, inst, key, pos in rows:
        if pos is not None:
            state.setdefault(inst, {})[key] = pos
        want[seq] = json.dumps(state.get(inst, {}), sort_keys=True, separators=(",", ":"))
    got = cursors.stamp_running(df, chunk_rows=13).collect()
    assert {r.seq: r.composite for r in got} == want


def test_composite_positions(spark):
    df = spark.createDataFrame([('{"b":"2","a":"1"}',), ("oops",), (None,)], "v string")
    m = cursors.parse_composite(F.col("v"))
    assert [r.m for r in df.select(m.alias("m")).collect()] == [{"b": "2", "a": "1"}, {}, {}]
    assert df.select(cursors.make_composite(m).alias("j")).first().j == '{"a":"1","b":"2"}'


def test_runs_of_failures(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(["hot", "hot", "b", None]), rng.random() < 0.4) for i in range(2000)]
    df = spark.createDataFrame(rows, "seq long, resource_id string, ok boolean")
    want, run = {}, {}
    for seq, res, ok in rows:
        run[res] = 0 if ok else run.get(res, 0) + 1
        want[seq] = (run[res], run[res] >= 5)
    got = X.failure_runs(df, chunk=ordered.seq_chunk("seq", 101)).collect()
    assert {r.seq: (r.failure_run, r.tripped) for r in got} == want


def test_retry_schedule(spark):
    rows = [(1, "a", "ConnectorNetworkError", None), (2, "a", "ConnectorRateLimitError", 7.0),
            (3, "a", "ConnectorNetworkError", None), (4, "b", "ConnectorAuthenticationError", None)]
    df = spark.createDataFrame(rows, "seq long, op_id string, error_type string, retry_after_s double") \
        .withColumn("ts", F.lit("2024-01-01").cast("timestamp")).withColumn("policy", F.lit("AGGRESSIVE"))
    out = {r.seq: (r.attempt, r.fatal, r.exhausted, r.wait_ms) for r in X.retry_due(df).collect()}
    assert out == {1: (1, False, False, 200.0), 2: (2, False, False, 7000.0), 3: (3, False, False, 300.0),
                   4: (1, True, False, None)}
    last = X.retry_due(df.withColumn("policy", F.lit("STANDARD"))).where("seq = 3").first()
    assert last.exhausted and last.next_attempt_at is None


def test_nested_children_above_the_document_limit(spark):
    parents = spark.createDataFrame([("p",), ("q",), ("r",)], "k string")
    kids = spark.createDataFrame([("p", i, "x" * 100) for i in range(50)] + [("q", 2, "b"), ("q", 1, "a")],
                                 "k string, n int, body string")
    out = {r.k: r for r in joins.nest(parents, kids, ["k"], F.struct("body"), ["n"], "kids", 1000).collect()}
    assert out["p"].kids is None and out["p"].kids_count == 50 and out["p"].kids_bytes == 5000
    assert [x.body for x in out["q"].kids] == ["a", "b"] and out["r"].kids == []
    left = joins.nest(parents, kids, ["k"], F.struct("body"), ["n"], "kids", 1000)
    docs = envelope(left, connector_id="c", instance_id=F.lit("i"), uri=F.col("k"), content=F.col("k"),
                    content_type="text/plain", seq=F.lit(1), withheld=joins.withheld("kids"))
    sizes = {r.source_ref.uri: r.size_bytes for r in docs.collect()}
    assert sizes == {"p": 5001, "q": 1, "r": 1}  # so that validation rejects p by its size
    full = {r.k: r for r in joins.nest(parents, kids, ["k"], F.struct("body"), ["n"], "kids").collect()}
    assert len(full["p"].kids) == 50


def test_mime_routes_yield_each_pair_once(spark):
    manifest = spark.createDataFrame([("all", "*/*"), ("all", "text/plain"), ("txt", "text/*"),
                                      ("txt", "text/plain"), ("js", "application/json")], "connector_id string, mime string")
    rows = spark.createDataFrame([(1, "text/plain"), (2, "application/json")], "seq int, content_type string")
    got = sorted((r.seq, r.connector_id) for r in joins.mime_routes(rows, manifest).collect())
    assert got == [(1, "all"), (1, "txt"), (2, "all"), (2, "js")]


def test_history(spark):
    log = spark.createDataFrame([(1, "j", "PENDING"), (2, "j", "RUNNING"), (3, "j", "COMPLETED"), (4, "j", "RUNNING")],
                                "seq long, job_id string, status string")
    assert [r.legal for r in history.job_transitions(log).orderBy("seq").collect()] == [True, True, False]
    probes = spark.createDataFrame([(1, "i", True), (2, "i", True), (3, "i", False), (4, "i", True)],
                                   "seq long, instance_id string, healthy boolean")
    assert [r.seq for r in history.health_changes(probes).orderBy("seq").collect()] == [3, 4]


def test_job_report_without_documents(spark):
    jobs = spark.createDataFrame([("j", None, None, "RUNNING")],
                                 "job_id string, started_at timestamp, completed_at timestamp, status string")
    row = aggregates.job_duration(jobs).first()
    assert row.duration_ms is None and not row.terminal


def test_repository_lifecycle(spark, docs, tmp_path):
    repo = R.Repository(spark, str(tmp_path / "repo"))
    repo.write(docs, 0)
    repo.write(docs, 0)
    repo.write(docs, 1)
    assert repo.stored().count() == 4
    one = docs.first()
    repo.update_status(docs.where(F.col("id") == one.id), "PROCESSING", 0, processed_by="w")
    repo.update_status(docs.where(F.col("id") == one.id), "FAILED", 1, error="bad")
    entry = repo.read(one.id).first()
    assert (entry.status, entry.attempts, entry.processing_error, entry.processed_by) == ("FAILED", 1, "bad", "w")
    assert "content" not in repo.read(one.id).columns
    assert repo.count(R.Filters(status="PENDING")).first().documents == 3
    assert repo.query(R.Filters(instance_id="inst-1", limit=2)).count() == 2
    assert repo.exists(spark.createDataFrame([("nope",)], "id string")).count() == 0
    again = R.Repository(spark, str(tmp_path / "repo"))
    assert again.read(one.id).first().cursor.value == one.cursor.value


def test_batch_runs_are_repeatable(spark, docs, tmp_path):
    store = str(tmp_path / "store")
    bad = docs.withColumn("content", F.when(F.col("seq") == 2, F.lit(b"")).otherwise(F.col("content")))
    first = batch.run_batch(bad, store, 0).first()
    assert (first.found, first.processed, first.skipped, first.failed) == (5, 3, 1, 1)
    again = batch.run_batch(bad, store, 0).first()
    assert again == first
    second = batch.run_batch(docs, store, 1).first()
    assert (second.processed, second.skipped, second.failed) == (1, 4, 0)
    stored = spark.read.parquet(f"{store}/repository/documents")
    assert stored.count() == 4 and stored.select("id").distinct().count() == 4
    letters = spark.read.parquet(f"{store}/dlq")
    assert letters.count() == 1 and letters.first().document.source_ref.uri.endswith("/2")
    assert spark.read.parquet(f"{store}/events").count() == 10
    place = {r.instance_id: r.value for r in batch.positions(spark, store).collect()}
    # Duplicates do not move a position; the last stored document does.
    assert place == {"inst-1": "2", "inst-2": "4"}


def test_shuffled_batch_gives_the_same_rows(docs, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "BROADCAST_ROWS", 0)
    got = batch.run_batch(docs, str(tmp_path / "s"), 0).first()
    assert (got.processed, got.skipped) == (4, 1)
    assert docs.sparkSession.read.parquet(str(tmp_path / "s/repository/documents")).count() == 4


def test_dead_letters(spark, docs):
    bad = docs.withColumn("content", F.lit(b""))
    entries = DL.enqueue(route.thin(bad), batch=F.lit(1), failed_at=F.timestamp_seconds(F.col("seq")))
    gone = DL.dismissal(entries.where("seq < 2"), "noise", F.timestamp_seconds(F.lit(9)))
    full = DL.with_dismissals(entries, gone)
    assert DL.size(full).first().active == 3
    assert [r.seq for r in DL.listing(full, DL.DeadLetterFilters(limit=2)).collect()] == [2, 3]
    assert DL.listing(full, DL.DeadLetterFilters(dismissed=True)).count() == 5
    assert DL.listing(full, DL.DeadLetterFilters(instance_id="inst-2")).count() == 1
    total = DL.stats(full).where("failure_type is null and connector_id is null").first()
    assert total.entries == 3 and total.oldest.second == 2


def test_histogram_by_ranks(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [("hot", float(v)) for v in rng.normal(size=3000).round(2)] + [("one", 5.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    rows += [(None, 7.0), (None, 8.0), ("hot", None)]
    got = {r.k: r for r in aggregates.histogram(spark.createDataFrame(rows, "k string, value double"), ["k"]).collect()}
    for k in {k for k, _ in rows}:
        values = [v for n, v in rows if n == k and v is not None]
        assert got[k].observations == sum(n == k for n, _ in rows)
        want = np.quantile(values, [0.5, 0.95, 0.99]) if values else [None] * 3
        assert [got[k].p50, got[k].p95, got[k].p99] == [w if w is None else pytest.approx(w) for w in want]


def test_histogram_exact_by_either_way(spark, monkeypatch):
    import numpy as np
    from harborline.operators import aggregates as A

    rng = np.random.default_rng(2)
    rows = [("a", float(v)) for v in rng.integers(0, 40, 700)] + [("b", float(v)) for v in rng.normal(size=300)] + [
        ("a", None), ("c", None), (None, 3.0)]
    seen = spark.createDataFrame(rows, "label string, value double")
    for few in (A.FEW_VALUES, 0):
        monkeypatch.setattr(A, "FEW_VALUES", few)
        got = {r.label: r for r in A.histogram(seen, ["label"]).collect()}
        for label in ("a", "b", "c", None):
            values = [v for k, v in rows if k == label and v is not None]
            assert got[label].observations == sum(k == label for k, _ in rows)
            for q, name in zip(A.MARKS, ("p50", "p95", "p99")):
                assert got[label][name] is None if not values else abs(got[label][name] - np.quantile(values, q)) < 1e-9


def test_merged_histogram_ranks(spark):
    from harborline.operators import aggregates as A

    seen = spark.range(200_000).selectExpr("cast(sqrt(id) * if(id % 3 = 0, -1, 1) as double) as value", "id % 11 as batch",
                                           "if(id % 20 = 0, 'b', 'a') as label")
    parts = [A.histogram_states(seen.where(f"batch = {i}"), ["label"]) for i in range(11)]
    states = parts[0]
    for p in parts[1:]:
        states = states.unionByName(p)
    states = states.unionByName(A.histogram_states(spark.createDataFrame([("n", None)], "label string, value double"), ["label"]))
    got = {r.label: r for r in A.merged_histogram(states, ["label"]).collect()}
    assert got["n"].observations == 1 and got["n"].p50 is None
    for label in "ab":
        values = sorted(r.value for r in seen.where(f"label = '{label}'").collect())
        assert got[label].observations == len(values)
        for q, name in zip(A.MARKS, ("p50", "p95", "p99")):
            rank = sum(v <= got[label][name] for v in values) / len(values)
            assert abs(rank - q) < 0.006
