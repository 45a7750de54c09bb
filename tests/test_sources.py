import base64
import json

import pytest
from pyspark.sql import functions as F

from harborline.operators import crawl
from harborline.sources import (chat, codehost, discovery, feeds, mail, notes, objects, tables, web,
                                webhook, wiki)
from harborline.sources.common import SourceRegistry, landed


def payloads(spark, items, schema, **extra):
    names = list(extra)
    df = spark.createDataFrame([(i, json.dumps(p), *extra.values()) for i, p in enumerate(items)],
                               ["n", "payload", *names])
    return landed(df, schema)


def content(df):
    return [json.loads(bytes(r.content)) for r in df.orderBy("seq").collect()]


def test_row_document(spark):
    df = spark.createDataFrame([(1, 5, 2)], "order_id int, product_id int, qty int")
    doc = tables.row_documents(df, "lines", "db", primary_keys=["order_id", "product_id"]).first()
    assert doc.source_ref.uri == "postgresql://public/lines/1|5" and doc.source_ref.version is None
    named = spark.createDataFrame([("u-1", "x")], "uuid string, id string")
    assert tables.row_documents(named, "t", "db").first().source_ref.uri.endswith("/x")
    dated = spark.sql("select 1 id, timestamp'2024-01-02 03:04:05.5' updated_at, 1.50bd price, X'00' raw")
    doc = tables.row_documents(dated, "t", "db").first()
    assert json.loads(bytes(doc.content)) == {"id": 1, "updated_at": "2024-01-02T03:04:05.500000+00:00",
                                              "price": 1.5, "raw": "<binary>"}
    assert doc.source_ref.version == "2024-01-02T03:04:05.500000+00:00"


def test_snapshot_without_its_column_reads_everything(spark):
    df = spark.range(10)
    assert tables.snapshot(df, "updated_at", "x").count() == 10
    assert tables.snapshot(df, "id", 6).count() == 3
    assert sorted(r.id for r in tables.snapshot(df, "id", 1, max_rows=2).collect()) == [2, 3]


def test_snapshot_keeps_ties_of_the_last_position(spark):
    df = spark.createDataFrame([(i, i // 3) for i in range(8)], "id long, at long")
    seen, since = [], None
    while rows := tables.snapshot(df, "at", since, max_rows=2).collect():
        seen += [r.id for r in rows]
        since = max(r["at"] for r in rows)
    assert sorted(seen) == list(range(8)) and len(seen) == 8
    assert tables.snapshot(df, "nowhere", 1, max_rows=2).count() == 8


def test_keyless_rows_differ_by_any_column(spark):
    df = spark.createDataFrame([("a", "b", "c", "d"), ("a", "b", "c", "e"), ("a|b", "", "c", "d")], "w string, x string, y string, z string")
    assert df.select(tables.row_pk(df).alias("k")).distinct().count() == 3


def test_catalog(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(7).withColumn("x", F.lit("a")).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    row = tables.inventory({"t": df}, sizes=True).first()
    on_disk = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert (row.columns, row.estimated_rows, row.size_bytes) == (2, 7, on_disk)
    listed = {r.column_name: r for r in tables.columns_of(spark, {"t": df}, {"t": ["id"]}).collect()}
    assert listed["id"].key_position == 1 and listed["x"].key_position is None


def test_change_log(spark):
    good = json.dumps({"action": "insert", "table": "users", "new": {"id": 1}})
    df = spark.createDataFrame([("0/1", good), ("0/2", "BEGIN 123"), ("0/3", "{oops")], "lsn string, data string")
    rows = tables.cdc_documents(df, "db").orderBy("seq").collect()
    assert [r.source_ref.uri for r in rows] == ["postgresql://cdc/users/0/1", "postgresql://cdc/unknown/0/2",
                                                "postgresql://cdc/unknown/0/3"]
    assert [json.loads(bytes(r.content)) for r in rows] == [
        {"lsn": "0/1", "change": json.loads(good)}, {"lsn": "0/2", "change": {"raw": "BEGIN 123"}},
        {"lsn": "0/3", "change": {"raw": "{oops", "lsn": "0/3"}}]
    assert list(rows[0].tags) == ["cdc", "table:users", "action:insert"]


def test_objects_from_files(spark, tmp_path):
    for name, body in {"a/x.md": "# x", "a/y.tmp": "t", "b/z.json": "{}", "empty.txt": ""}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    found = objects.listing(objects.read_objects(spark, str(tmp_path)), str(tmp_path))
    docs = {r.source_ref.uri: r for r in objects.object_scan(found, "b1", "i").collect()}
    assert set(docs) == {"s3://b1/a/x.md", "s3://b1/b/z.json"}
    assert docs["s3://b1/a/x.md"].content_type == "text/markdown"
    later = docs["s3://b1/a/x.md"].cursor.value
    assert objects.object_scan(found, "b1", "i", since=max(later, docs["s3://b1/b/z.json"].cursor.value)).count() == 0
    assert objects.object_scan(found, "b1", "i", limit=1).count() == 1
    assert {r.resource for r in objects.object_prefixes(found, "b1").collect()} == {"s3://b1/a/", "s3://b1/b/"}


RSS = """<?xml version="1.0"?><rss><channel><item><title>One</title><link>https://x/1</link>
<description>d1</description><pubDate>Mon, 01 Jan 2024 00:00:00 GMT</pubDate></item>
<item><title>Old</title><pubDate>never</pubDate></item><item><description>no link</description>
<pubDate>Tue, 02 Jan 2024 00:00:00 GMT</pubDate></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><id>urn:1</id>
<link href="https://x/a"/><updated>2024-01-03T00:00:00Z</updated><summary>s</summary></entry></feed>"""


def test_feeds(spark, tmp_path):
    df = spark.createDataFrame([("f1", RSS), ("f2", ATOM), ("f3", "<broken")], "feed_url string, xml string")
    items = feeds.feed_items(df)
    assert items.count() == 4
    docs = {r.source_ref.uri.split("#")[0]: r for r in feeds.feed_documents(items, "r").collect()}
    assert set(docs) == {"https://x/1", "f1", "https://x/a"} and bytes(docs["https://x/a"].content) == b"s"
    assert feeds.feed_documents(items, "r", since=1704067200.0).count() == 2
    (tmp_path / "f.xml").write_text(RSS)
    assert feeds.read_items(spark, str(tmp_path)).count() == 3


def test_api_items(spark):
    body = lambda x: json.dumps({"data": {"items": x}})
    df = spark.createDataFrame([("/v1/a", 1, body([{"id": 7}, {"uuid": "u"}, {"k": 1}])), ("/v1/a", 2, body({"id": 8})),
                                ("/v1/b", 1, body(None)), ("/v1/b", 2, body(3))], "endpoint string, page_no int, body string")
    docs = web.api_documents(web.api_items(df, "data.items"), "https://h/", "w").collect()
    tails = sorted(r.source_ref.uri.rsplit("/", 1)[1] for r in docs)
    assert len(tails) == 4 and {"7", "8", "u"} < set(tails)
    assert web.api_items(df, "data.items", per_endpoint=2).count() == 2


def test_chat_messages(spark):
    base = {"type": "message", "text": "t"}
    msgs = [{**base, "ts": "1.0", "user": "U1", "thread_ts": "1.0", "reply_count": 2},
            {**base, "ts": "2.0", "user": "U2", "thread_ts": "1.0"}, {**base, "ts": "3.0", "bot_id": "B"},
            {**base, "ts": "4.0", "user": "U3", "subtype": "channel_join"}, {**base, "ts": "5.0", "thread_ts": "1.0"}]
    df = payloads(spark, msgs, chat.MESSAGE, channel_id="C1").select("n", "channel_id", "p.*")
    docs = chat.messages(df, "s", seq=F.col("n"))
    got = content(docs)
    assert [g["ts"] for g in got] == ["1.0", "2.0", "5.0"]
    assert [r["ts"] for r in got[0]["replies"]] == ["2.0", "5.0"] and "replies" not in got[1]
    assert got[1]["subtype"] is None and docs.where("seq = 0").first().source_ref.uri == "slack://message/C1/1.0"
    # Size and checksum describe what is stored.
    assert docs.where("sha2(content, 256) <> checksum").count() == 0
    assert chat.messages(df, "s", include_bots=True).count() == 5


def b64(text):
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


def test_mail_parts(spark):
    leaf = lambda mime, text, **kw: {"mimeType": mime, "body": {"data": b64(text), "size": len(text)}, **kw}
    tree = {"mimeType": "multipart/mixed", "headers": [{"name": "Subject", "value": "Hi"}, {"name": "FROM", "value": "a"}],
            "parts": [{"mimeType": "multipart/alternative", "parts": [leaf("text/html", "<p>é?</p>"), leaf("text/plain", "first"),
                                                                     leaf("text/plain", "second")]},
                      {"mimeType": "text/plain", "filename": "big.txt", "body": {"size": 9_000_000, "data": b64("no")}},
                      {"mimeType": "image/png", "filename": "p.png", "body": {"size": 10, "attachmentId": "x"},
                       "parts": [leaf("text/plain", "inside a file")]}]}
    flat = {"mimeType": "text/plain", "body": {"data": b64("only")}}
    msgs = [{"id": "m1", "threadId": "t", "internalDate": "5", "labelIds": ["INBOX"], "payload": tree},
            {"id": "m2", "internalDate": "6", "payload": flat}]
    df = payloads(spark, msgs, mail.MESSAGE)
    one, two = content(mail.messages(df, "g", body_format="both", seq=F.col("n")))
    assert (one["body_text"], one["body_html"], one["subject"], one["from"]) == ("first", "<p>é?</p>", "Hi", "a")
    assert one["attachments"] == [{"name": "p.png", "size": 10, "mime": "image/png"}]
    assert (two["body_text"], two["subject"], two["attachments"]) == ("only", "(no subject)", [])
    assert mail.messages(df, "g", labels=["INBOX", "SPAM"]).count() == 1
    assert mail.messages(df, "g", since_ms=5).count() == 1


def test_wiki_content(spark):
    page = {"id": "1", "title": "T", "type": "page", "version": {"number": 3, "when": "2024"}, "space": {"key": "K"},
            "ancestors": [{"title": "Up"}], "_links": {"webui": "/p/1"}, "body": {"storage": {"value": "<p>a &amp; b</p>"}}}
    df = payloads(spark, [page, {"body": {"storage": {"value": " "}}}], wiki.CONTENT)
    docs = wiki.content_documents(df, "https://w/", "k", seq=F.col("n")).orderBy("seq").collect()
    assert bytes(docs[0].content).decode() == "T\n\na & b" and docs[0].source_ref.version == "3"
    assert docs[1].content_type == "text/plain" and bytes(docs[1].content).decode() == "Untitled\n\n"
    assert wiki.content_documents(df, "https://w", "k", "storage").count() == 1


def test_note_pages(spark):
    title = lambda t: {"type": "title", "title": [{"plain_text": t}]}
    pages = [{"id": "p1", "url": "u1", "last_edited_time": "2024-02", "properties": {"Name": title("N")},
              "icon": {"type": "emoji", "emoji": "x"}}, {"id": "p2", "url": "u2", "last_edited_time": "2024-01", "archived": True},
             {"id": "p3", "url": "u3", "last_edited_time": "2024-03", "parent": {"type": "database_id", "database_id": "d"}}]
    df = payloads(spark, pages, notes.PAGE)
    blocks = spark.createDataFrame(
        [("b1", "p1", 0, "heading_1", "H", False), ("b2", "p1", 1, "bulleted_list_item", "one", True),
         ("b3", "b2", 0, "to_do", "in", False), ("b4", "p1", 2, "paragraph", "", True), ("b5", "b4", 0, "quote", "q", False),
         ("b6", "p1", 3, "code", "c", False)],
        "block_id string, parent_id string, ordinal int, type string, text string, has_children boolean")
    md = notes.pages_markdown(df.select("p.id"), blocks)
    docs = {r.source_ref.uri: r for r in notes.page_documents(df, md, "n").collect()}
    assert bytes(docs["u1"].content).decode() == "# H\n\n- one\n\n  - [ ] in\n\n> q\n\n```\nc\n```"
    assert set(docs) == {"u1", "u3"} and json.loads(bytes(docs["u3"].content))["title"] == "Untitled"
    assert json.loads(docs["u3"].source_metadata)["parent_id"] == "d"


def test_code_host(spark):
    user = {"login": "me"}
    issue = {"number": 1, "title": "I", "state": "open", "html_url": "h/1", "created_at": "a", "updated_at": "b",
             "user": user, "labels": [{"name": "bug"}], "assignees": [user]}
    rows = payloads(spark, [issue, {**issue, "number": 2, "pull_request": {"url": "x"}}], codehost.ISSUE, repo="o/r")
    talk = payloads(spark, [{"user": user, "body": "c2", "created_at": "2"}, {"body": "c1", "created_at": "1"}],
                    codehost.COMMENT, repo="o/r", number=1).withColumnRenamed("p", "c")
    got = content(codehost.issues(rows, talk, "h", seq=F.col("n")))
    assert len(got) == 1 and [c["body"] for c in got[0]["comments"]] == ["c1", "c2"]
    assert got[0]["body"] == "" and got[0]["milestone"] is None and got[0]["labels"] == ["bug"]

    pull = {"number": 3, "title": "P", "state": "closed", "html_url": "h/3", "created_at": "a", "updated_at": "b", "user": user,
            "merged_at": "m", "base": {"ref": "main"}, "head": {"ref": "f", "sha": "s"}}
    rows = payloads(spark, [pull, {**pull, "number": 4, "draft": True}], codehost.PULL, repo="o/r")
    none = talk.limit(0)
    review = payloads(spark, [{"user": user, "state": "APPROVED", "submitted_at": "1"}], codehost.REVIEW, repo="o/r",
                      number=3).withColumnRenamed("p", "r")
    got = content(codehost.pulls(rows, review, none, "h", seq=F.col("n")))
    assert len(got) == 1 and (got[0]["state"], got[0]["merged"], len(got[0]["reviews"]), got[0]["comments"]) == (
        "merged", True, 1, [])

    commit = {"sha": "s", "commit": {"message": "m", "committer": {"name": "c", "date": "d2"}},
              "files": [{"filename": f"f{i}"} for i in range(60)]}
    for most, left in ((None, 60), (50, 50)):
        doc = codehost.commits(payloads(spark, [commit], codehost.COMMIT, repo="o/r"), "h", max_files=most).first()
        assert doc.cursor.value == "d2" and len(json.loads(bytes(doc.content))["files_changed"]) == left
    release = {"id": 9, "tag_name": "v1", "html_url": "h", "prerelease": True, "author": user}
    rows = payloads(spark, [release, {**release, "id": 10}], codehost.RELEASE, repo="o/r")
    assert codehost.releases(rows, "h", since_id=9).count() == 1
    assert codehost.releases(rows, "h", include_prereleases=False).count() == 0


def test_code_files(spark):
    tree = spark.createDataFrame([("o/r", "main", "T", p, "blob", s, n) for p, s, n in [
        ("a.py", "s1", 3), ("b.png", "s2", 3), ("big.py", "s3", 2_000_000), ("c.md", "s4", 2)]],
        "repo string, branch string, tree_sha string, path string, type string, sha string, size long")
    blobs = spark.createDataFrame([("s1", "base64", "YW\nJj"), ("s4", "rot13", "x")], "sha string, encoding string, content string")
    docs = codehost.files(codehost.wanted_files(tree), blobs, "h").collect()
    assert [(bytes(d.content), d.content_type, d.cursor.value) for d in docs] == [(b"abc", "text/x-python", "T")]
    seen = spark.createDataFrame([("o/r", "T")], "repo string, tree_sha string")
    assert codehost.wanted_files(tree, stored_trees=seen).count() == 0
    assert codehost.wanted_files(tree, ["*.md"]).count() == 1


def test_deliveries(spark):
    body = json.dumps({"ref": "refs/heads/dev", "repository": {"full_name": "o/r"}, "sender": {"login": "me"},
                       "commits": [{"added": ["a", "b"]}, {"modified": ["a"], "removed": ["b"]}]})
    df = spark.createDataFrame([(body, {"X-GitHub-Event": "push", "x-github-delivery": "d1"}), ("nope", {})],
                               "body string, headers map<string,string>")
    rows = webhook.events(df)
    one = rows.first()
    assert rows.count() == 1 and (one.event_type, one.delivery_id, one.repo, one.sender, one.action) == (
        "push", "d1", "o/r", "me", None)
    assert webhook.events(df, "secret").count() == 0 and webhook.acquiring(rows).count() == 1
    assert {(r.path, r.status) for r in webhook.push_file_status(rows).collect()} == {("a", "modified"), ("b", "removed")}
    assert [r.resource for r in webhook.affected_resources(rows).orderBy("pos").collect()] == [
        f"https://github.com/o/r/blob/dev/{f}" for f in "aba"]
    assert webhook.ref_info(rows).first().branch == "dev"


def test_discovery(spark):
    df = spark.range(5)
    found = discovery.resources([("a", df, F.concat(F.lit("a://"), "id")), ("b", df.limit(1), F.lit("b://x"))])
    assert discovery.listed(found).where("truncated").count() == 0
    cut = discovery.listed(found, 2).collect()
    assert len(cut) == 3 and {(r.connector_id, r.total, r.truncated) for r in cut} == {("a", 5, True), ("b", 1, False)}


def test_own_source(spark, docs):
    registry = SourceRegistry()
    registry.register("mine", lambda rows, cursors, **o: rows.limit(o["n"]))
    assert registry.pull("mine", docs, n=2).count() == 2
    with pytest.raises(ValueError):
        registry.register("mine", None)


def test_crawl(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("c", "a")],
                                  "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "url string")
    got = {r.url: r.depth for r in crawl.bfs_depth(edges, seeds).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3}
    assert crawl.bfs_depth(edges, seeds, max_pages=2).count() == 2
    reached = crawl.bfs_depth(edges, seeds, max_depth=1)
    assert [tuple(r) for r in crawl.frontier(edges, reached, reached).collect()] == [("d", 2)]


def spread_over(rows):
    return rows.select(F.spark_partition_id().alias("p")).distinct().count()


def test_commits_of_one_row_group_are_work_for_all_cores(spark, tmp_path):
    from harborline.queries import codehost as Q
    from harborline.queries.registry import Tables

    spark.range(200).selectExpr("id as c_custkey", "concat('n', id) as c_name").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    rows = Q.commits(Tables(spark, str(tmp_path)))
    assert spread_over(rows) >= 4 and sorted(r.c_custkey for r in rows.select("c_custkey").collect()) == [*range(200)]


def test_issues_pulls_and_comments_of_one_row_group_are_work_for_all_cores(spark, tmp_path):
    from harborline.queries import codehost as Q
    from harborline.queries.registry import Tables

    t = Tables(spark, str(tmp_path))
    day = "timestamp'2024-01-01' as {}"
    spark.range(200).selectExpr("id as o_orderkey", "id as o_custkey", "'F' as o_orderstatus", "'1' as o_orderpriority",
                                day.format("o_orderdate")).coalesce(1).write.parquet(t.path("orders"))
    spark.range(200).selectExpr("id as l_orderkey", "id as l_partkey", "id as l_suppkey", "1 as l_linenumber", "2.0D as l_quantity",
                                "'R' as l_returnflag", day.format("l_shipdate")).coalesce(1).write.parquet(t.path("lineitem"))
    for rows, key in ((Q.issues(t), "o_orderkey"), (Q.pulls(t), "o_orderkey"), (Q.comments(t), "number"), (Q.reviews(t), "number")):
        assert spread_over(rows) >= 4 and sorted(r[0] for r in rows.select(key).collect()) == [*range(200)]
    assert {r[0] for r in Q.pulls(t).select("p.merged_at").collect()} == {"2024-01-01T00:00:00Z"}
