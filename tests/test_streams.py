import random

from pyspark.sql import functions as F

from harborline.operators.ordered import seq_chunk
from harborline.sources import objects, webhook
from harborline.streaming import alerts, intake


def land(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def run(stream, work, checkpoint):
    intake.start(stream, work, checkpoint).awaitTermination()


def to_documents(batch):
    from harborline.operators.envelope import envelope
    return envelope(batch, connector_id="files", instance_id=F.lit("i"), uri=F.col("uri"), content=F.col("body"),
                    content_type="text/plain", seq=F.col("n"), cursor_value=F.col("n"),
                    acquired_at=F.timestamp_seconds(F.col("n")))


def test_processing_stores_once_across_restarts(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    schema = "n long, uri string, body string"
    land(spark, folder, "one", [(1, "a", "x"), (2, "b", "y"), (3, "a", "z")], schema)
    go = lambda: run(intake.read_table(spark, f"{folder}/*"), intake.process_to(store, to_documents), str(tmp_path / "cp"))
    go()
    go()  # nothing new
    land(spark, folder, "two", [(4, "b", "again"), (5, "c", "new"), (6, "d", "")], schema)
    go()
    stored = spark.read.parquet(f"{store}/repository/documents")
    assert sorted((r.source_ref.uri, bytes(r.content).decode()) for r in stored.collect()) == [
        ("a", "x"), ("b", "y"), ("c", "new")]
    jobs = {r.batch_id: (r.processed, r.skipped, r.failed) for r in spark.read.parquet(f"{store}/jobs").collect()}
    assert jobs == {0: (2, 1, 0), 1: (1, 1, 1)}


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    store = str(tmp_path / "store")
    batch = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "n long, uri string, body string")
    work = intake.process_to(store, to_documents)
    for batch_id in (0, 0, 1):
        work(batch, batch_id)
    assert spark.read.parquet(f"{store}/repository/documents").count() == 2


def test_file_drop_sees_each_file_once(spark, tmp_path):
    drop, out = tmp_path / "drop", str(tmp_path / "out")
    drop.mkdir()
    (drop / "a.md").write_text("A")
    (drop / "skip.tmp").write_text("T")
    docs = lambda: objects.object_scan(objects.listing(intake.read_drop(spark, str(drop)), str(drop)), "b", "i",
                                       seq=F.lit(0))
    go = lambda: run(docs(), intake.append_to(out), str(tmp_path / "cp"))
    go()
    (drop / "b.md").write_text("B")
    go()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.batch_id, r.source_ref.uri) for r in rows) == [(0, "s3://b/a.md"), (1, "s3://b/b.md")]


def test_repeated_deliveries_are_dropped(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    body = '{"repository": {"full_name": "o/r"}}'
    row = lambda i, at: (body, {"X-GitHub-Event": "push", "X-GitHub-Delivery": f"d{i}"}, at)
    schema = "body string, headers map<string,string>, at long"
    stream = lambda: intake.webhook_stream(intake.read_table(spark, f"{folder}/*").withColumn(
        "received_at", F.timestamp_seconds("at")), None)
    go = lambda: run(stream().select("delivery_id"), intake.append_to(out), str(tmp_path / "cp"))
    land(spark, folder, "one", [row(1, 100), row(1, 101), row(2, 102)], schema)
    go()
    land(spark, folder, "two", [row(2, 110), row(3, 111)], schema)
    go()
    assert sorted(r.delivery_id for r in spark.read.parquet(out).collect()) == ["d1", "d2", "d3"]


def test_rows_of_any_time_are_kept(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id string, acquired_at long"
    go = lambda: run(intake.bounded_dedup(intake.read_table(spark, f"{folder}/*")), intake.append_to(out), str(tmp_path / "cp"))
    for name, rows in (("a", [("a", 900_000)]), ("b", [("b", 900_001), ("a", 900_002)]), ("c", [("c", 1)])):
        land(spark, folder, name, rows, schema)
        go()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_state_crosses_batches_and_restarts(spark, tmp_path):
    """One file a micro-batch; the stream ends after two and goes on from its
    checkpoint; repeats of every earlier batch are dropped and remembered once."""
    folder, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    parts = [["a", "b"], ["b", "c", "a"], ["c", "d", "a", "e"]]
    stream = lambda: intake.bounded_dedup(intake.read_table(spark, f"{folder}/*", max_files=1).select("id"))
    for i, ids in enumerate(parts):
        land(spark, folder, f"p{i}", [(x,) for x in ids], "id string")
        if i:
            run(stream(), intake.append_to(out), checkpoint)
        if i == 1:
            assert sorted(r.key.id for r in intake.remembered(spark, checkpoint).collect()) == ["a", "b", "c"]
    got = sorted((r.batch_id, r.id) for r in spark.read.parquet(out).collect())
    assert [x for _, x in got] == list("abcde") and [b for b, _ in got[:3]] == [0, 0, 1]
    assert got[3][0] == got[4][0] > 1  # a batch without data may close the first run
    assert sorted(r.key.id for r in intake.remembered(spark, checkpoint).collect()) == ["a", "b", "c", "d", "e"]
    run(stream(), intake.append_to(out), checkpoint)  # nothing new, nothing changes
    assert sorted((r.batch_id, r.id) for r in spark.read.parquet(out).collect()) == got


def test_deliveries_without_id_are_known_by_their_body(spark):
    bodies = ['{"repository": {"full_name": "o/r%d"}}' % (i % 3) for i in range(5)]
    rows = spark.createDataFrame([(b, {"X-GitHub-Event": "push", **({"X-GitHub-Delivery": " "} if i else {})})
                                  for i, b in enumerate(bodies)], "body string, headers map<string,string>")
    ids = [r.delivery_id for r in webhook.events(rows).collect()]
    assert len(ids) == 5 and len(set(ids)) == 3 and all(i.startswith("sha256:") for i in ids)


def test_alerts_keep_state_between_runs(spark, tmp_path):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), i, rng.random() < 0.4) for i in range(400)]
    want, last = [], {}
    for res, seq, ok in rows:
        if res in last and last[res] != ok:
            want.append((res, seq, "HEALTHY" if ok else "UNHEALTHY"))
        last[res] = ok
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    schema = "resource_id string, seq long, ok boolean"
    work = alerts.alerts_to(store, seq_chunk("seq", 13))
    for part in (rows[:150], rows[150:]):
        land(spark, folder, f"p{len(part)}", part, schema)
        run(intake.read_table(spark, f"{folder}/*"), work, str(tmp_path / "cp"))
    work(intake_rows(spark, rows[150:], schema), 1)  # a replayed batch changes nothing
    got = [(r.resource_id, r.seq, r.current) for r in alerts.stored_alerts(spark, store).collect()]
    assert sorted(got) == sorted(want)


def intake_rows(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_a_file_that_arrives_is_work_for_all_cores(spark, tmp_path):
    """A micro-batch takes one file, which one task reads; what follows is dealt out."""
    from pyspark.sql import functions as F
    from harborline.queries.registry import Tables
    from harborline.queries.streams import Arriving

    spark.range(300).selectExpr("id as event_id").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    t = Arriving(Tables(spark, str(tmp_path)), "events", "event_id")
    t.land(0)
    seen = []

    def work(batch, batch_id):
        seen.append((batch.select("task").distinct().count(), sorted(r.event_id for r in batch.collect())))

    stream = t.events.withColumn("task", F.spark_partition_id())
    stream.writeStream.foreachBatch(work).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert sorted(x for _, rows in seen for x in rows) == [*range(100)] and max(n for n, _ in seen) >= 4
