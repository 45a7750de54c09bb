"""Table snapshots, row documents, catalog, change logs, objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions.codec import lsn_order
from harborline.operators.joins import primary_keys, table_sizes
from harborline.queries import derive as D
from harborline.queries.core import PATHS_SQL, paths
from harborline.queries.registry import Tables, query
from harborline.sources import discovery, objects, tables as S
from harborline.sources.common import iso

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
ISO_DAY = "strftime({}, '%Y-%m-%dT%H:%M:%S')"


@query("src_table_snapshot", """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate > TIMESTAMP '1998-06-01'""")
def src_table_snapshot(t: Tables):
    return S.snapshot(t.orders, "o_orderdate", "1998-06-01").select(
        "o_orderkey", "o_orderdate", "o_totalprice")


@query("src_table_row_docs", f"""WITH r AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
  {ISO_DAY.format('o_orderdate')} AS day FROM orders)
SELECT sha256('db1:postgresql://public/orders/' || o_orderkey) AS id,
  'postgresql://public/orders/' || o_orderkey AS uri, day AS version,
  'row|table:orders|schema:public' AS tags, 'application/json' AS content_type,
  o_custkey::VARCHAR AS f_custkey, day AS f_orderdate, o_orderstatus AS f_status,
  'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS meta_columns FROM r""")
def src_table_row_docs(t: Tables):
    docs = S.row_documents(t.orders, "orders", "db1", primary_keys=["o_orderkey"],
                           cursor_column="o_orderdate", seq=F.col("o_orderkey"))
    body = F.col("content").cast("string")
    cols = F.from_json("source_metadata", "columns array<string>")["columns"]
    return docs.select(
        "id", "source_ref.uri", "source_ref.version", F.array_join("tags", "|").alias("tags"),
        "content_type", F.get_json_object(body, "$.o_custkey").alias("f_custkey"),
        F.get_json_object(body, "$.o_orderdate").alias("f_orderdate"),
        F.get_json_object(body, "$.o_orderstatus").alias("f_status"),
        F.array_join(cols, ",").alias("meta_columns"))


CUSTOMER_KEY = " || '|' || ".join(
    f"length({c}::VARCHAR) || ':' || {c}::VARCHAR"
    for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))


@query("src_row_pk", f"""
SELECT 'lineitem' AS tab, l_orderkey || '|' || l_linenumber AS pk FROM lineitem
UNION ALL SELECT 'customer', sha256({CUSTOMER_KEY}) FROM customer
UNION ALL SELECT 'part', p_partkey::VARCHAR FROM part""")
def src_row_pk(t: Tables):
    pk = lambda name, df, keys=(): df.select(F.lit(name).alias("tab"), S.row_pk(df, keys).alias("pk"))
    part = t.part.withColumnRenamed("p_partkey", "id")
    return (pk("lineitem", t.lineitem, ["l_orderkey", "l_linenumber"])
            .unionByName(pk("customer", t.customer)).unionByName(pk("part", part)))


@query("src_row_serializable", f"""SELECT event_id, {ISO_DAY.format('ts')} ||
  CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS ts,
  '<binary>' AS raw, value, user_id FROM events""")
def src_row_serializable(t: Tables):
    e = t.events.select("event_id", "ts", F.encode("props", "UTF-8").alias("raw"),
                        F.col("value").cast("decimal(12,2)").alias("value"), "user_id")
    return S.serializable(e)


@query("src_table_inventory", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, (SELECT count(*) FROM information_schema.columns "
    f"WHERE table_name = '{n}')::INT AS columns, count(*) AS estimated_rows FROM {n}" for n in TABLES))
def src_table_inventory(t: Tables):
    return S.inventory({n: getattr(t, n) for n in TABLES})


@query("jn_pk_constraints", """WITH k AS (SELECT l_orderkey % 500 AS no,
    CASE WHEN l_linenumber % 2 = 0 THEN 'PRIMARY KEY' ELSE 'UNIQUE' END AS kind, l_linenumber FROM lineitem),
tc AS (SELECT DISTINCT no, kind, kind || no AS cname FROM k),
kcu AS (SELECT DISTINCT kind || no AS cname, l_linenumber FROM k)
SELECT 't' || no AS table_name, 'c' || l_linenumber AS column_name, l_linenumber::INT AS ordinal_position
FROM tc JOIN kcu USING (cname) WHERE kind = 'PRIMARY KEY'""")
def jn_pk_constraints(t: Tables):
    k = t.lineitem.select(
        (F.col("l_orderkey") % 500).alias("no"), "l_linenumber",
        F.when(F.col("l_linenumber") % 2 == 0, "PRIMARY KEY").otherwise("UNIQUE")
        .alias("constraint_type")).withColumn(
        "constraint_name", F.concat("constraint_type", F.col("no").cast("string")))
    constraints = k.select("constraint_name", "constraint_type", F.lit("public").alias("table_schema"),
                           F.concat(F.lit("t"), "no").alias("table_name")).distinct()
    columns = k.select("constraint_name", F.concat(F.lit("c"), "l_linenumber").alias("column_name"),
                       F.col("l_linenumber").alias("ordinal_position")).distinct()
    return primary_keys(constraints, columns).select("table_name", "column_name", "ordinal_position")


@query("jn_table_sizes", """SELECT 'o' || (o_orderkey % 300) AS table_name, count(*) AS estimated_rows,
  sum(round(o_totalprice))::BIGINT AS size_bytes FROM orders WHERE o_orderkey % 300 % 3 <> 0 GROUP BY 1""")
def jn_table_sizes(t: Tables):
    n = F.col("o_orderkey") % 300
    o = t.orders.select(n.alias("n"), "o_totalprice")
    listed = o.select("n").distinct().select(
        F.concat(F.lit("o"), "n").alias("table_name"), F.lit("public").alias("table_schema"),
        F.when(F.col("n") % 3 == 0, "VIEW").otherwise("BASE TABLE").alias("table_type"))
    sizes = o.groupBy(F.concat(F.lit("o"), "n").alias("relname")).agg(
        F.count("*").alias("estimated_rows"),
        F.sum(F.round("o_totalprice")).cast("bigint").alias("size_bytes"))
    return table_sizes(listed, sizes, "public")


# ----------------------------------------------------------------- change log


def changes(t: Tables):
    e = F.col("event_id")
    lsn = F.concat(F.upper(F.hex(F.floor(e / 256))), F.lit("/"), F.upper(F.hex((e % 256) * 16)))
    data = (F.when(e % 9 == 0, F.concat(F.lit("BEGIN "), e.cast("string")))
            .when(e % 9 == 1, F.lit("{broken"))
            .when(e % 9 == 2, F.to_json(F.struct(F.lit("orders").alias("table"), "value")))
            .otherwise(F.to_json(F.struct(
                F.col("event_type").alias("action"), F.concat(F.lit("t"), F.col("user_id") % 5)
                .alias("table"), F.struct("user_id", "value").alias("new")))))
    return t.events.select(e, lsn.alias("lsn"), data.alias("data"))


CHANGES_SQL = """chg AS (SELECT event_id, hex(event_id // 256) || '/' || hex(event_id % 256 * 16) AS lsn,
  CASE WHEN event_id % 9 IN (0, 1, 2) THEN 'unknown' ELSE event_type END AS action,
  CASE WHEN event_id % 9 IN (0, 1) THEN 'unknown' WHEN event_id % 9 = 2 THEN 'orders'
    ELSE 't' || (user_id % 5) END AS tab,
  CASE WHEN event_id % 9 = 0 THEN 'BEGIN ' || event_id WHEN event_id % 9 = 1 THEN '{broken' END AS raw,
  CASE WHEN event_id % 9 > 2 THEN user_id::VARCHAR END AS new_user FROM events)"""
CDC_FIELDS_SQL = """SELECT sha256('db1:postgresql://cdc/' || tab || '/' || lsn) AS id,
  'postgresql://cdc/' || tab || '/' || lsn AS uri, lsn AS version, lsn AS cursor_value,
  'cdc|table:' || tab || '|action:' || action AS tags, lsn AS f_lsn, raw AS f_raw,
  new_user AS f_user FROM chg"""


def cdc_fields(docs):
    body = F.col("content").cast("string")
    return docs.select(
        "id", "source_ref.uri", "source_ref.version", F.col("cursor.value").alias("cursor_value"),
        F.array_join("tags", "|").alias("tags"), F.get_json_object(body, "$.lsn").alias("f_lsn"),
        F.get_json_object(body, "$.change.raw").alias("f_raw"),
        F.get_json_object(body, "$.change.new.user_id").alias("f_user"))


@query("src_cdc_docs", f"WITH {CHANGES_SQL} {CDC_FIELDS_SQL}")
def src_cdc_docs(t: Tables):
    return cdc_fields(S.cdc_documents(changes(t), "db1"))


@query("cur_lsn_order", """SELECT event_id, hex(event_id // 256) || '/' || hex(event_id % 256 * 16) AS lsn,
  ((event_id // 256) * 4294967296 + event_id % 256 * 16)::VARCHAR AS position FROM events""")
def cur_lsn_order(t: Tables):
    return changes(t).select("event_id", "lsn", lsn_order(F.col("lsn")).cast("string")
                             .alias("position"))


# -------------------------------------------------------------------- objects


def stored_objects(t: Tables):
    """One object per document, listed with an age."""
    return paths(t).select(
        "doc_id", F.col("path").alias("key"), F.col("size"),
        iso(D.at(F.col("doc_id") * 60), "+00:00").alias("last_modified"),
        F.md5(F.encode("text", "UTF-8")).alias("etag"), F.encode("text", "UTF-8").alias("content"))


@query("src_object_scan", f"""WITH {PATHS_SQL},
o AS (SELECT *, strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 60), '%Y-%m-%dT%H:%M:%S')
  || '+00:00' AS last_modified, CASE WHEN ext = '.gz' THEN 'application/octet-stream' WHEN ext = '.py' THEN 'text/x-python'
  WHEN ext = '.md' THEN 'text/markdown' WHEN ext = '.json' THEN 'application/json'
  WHEN ext = '.png' THEN 'image/png' WHEN ext = '.pdf' THEN 'application/pdf'
  WHEN ext = '.html' THEN 'text/html' ELSE 'application/octet-stream' END AS content_type FROM exts)
SELECT sha256('i1:s3://lake/' || path) AS id, 's3://lake/' || path AS uri, md5(text) AS version,
  size AS size_bytes, content_type, last_modified AS cursor_value FROM o
WHERE starts_with(path, 'src1') AND size > 0 AND size <= 20000
  AND ext NOT IN ('.tmp', '.log', '.lock', '.pyc') AND last_modified > '2024-01-01T01:00:00+00:00'""")
def src_object_scan(t: Tables):
    docs = objects.object_scan(stored_objects(t), "lake", "i1", prefix="src1", max_bytes=20000,
                               since="2024-01-01T01:00:00+00:00", seq=F.col("doc_id"))
    return docs.select("id", "source_ref.uri", "source_ref.version", "size_bytes", "content_type",
                       F.col("cursor.value").alias("cursor_value"))


@query("src_object_prefixes", f"""WITH {PATHS_SQL} SELECT 's3://lake/' || split_part(path, '/', 1) || '/' AS resource,
  count(*) AS objects FROM paths GROUP BY 1""")
def src_object_prefixes(t: Tables):
    return objects.object_prefixes(stored_objects(t), "lake")


def object_versions(t: Tables):
    """A version per document: a third of them of one object, the others of
    objects with about seven; some at the same instant, every eleventh a
    delete marker."""
    k = F.col("doc_id")
    return t.documents.select(
        F.when(k % 3 == 0, "hot/a.txt").otherwise(F.concat(F.lit("src/o"), F.floor(k / 10), F.lit(".md"))).alias("key"),
        D.at(k * 37 % 501 * 600).alias("at"), k.alias("seq"), (k % 11 == 5).alias("deleted"),
        F.octet_length(F.encode("text", "UTF-8")).cast("long").alias("size"), F.md5(F.encode("text", "UTF-8")).alias("etag"),
        F.encode("text", "UTF-8").alias("content"))


VERSION_SQL = """ov AS (SELECT doc_id AS seq, CASE WHEN doc_id % 3 = 0 THEN 'hot/a.txt'
    ELSE 'src/o' || (doc_id // 10) || '.md' END AS key, TIMESTAMP '2024-01-01' + to_seconds(doc_id * 37 % 501 * 600) AS since,
  doc_id % 11 = 5 AS deleted, md5(text) AS etag, text FROM documents),
oc AS (SELECT *, lead(since) OVER (PARTITION BY key ORDER BY since, seq) AS until FROM ov)"""


@query("src_object_versions", f"""WITH {VERSION_SQL} SELECT seq, 's3://lake/' || key || '?versionId=' || seq AS uri,
  etag AS version, sha256(text) AS checksum, strftime(since, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS valid_from,
  strftime(until, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS valid_to, CASE WHEN until IS NULL THEN 'true' ELSE 'false' END AS is_latest
FROM oc WHERE NOT deleted""")
def src_object_versions(t: Tables):
    docs = objects.version_documents(objects.version_chains(object_versions(t)), "lake", "i1", seq=F.col("seq"))
    m = lambda f: F.get_json_object("source_metadata", f"$.{f}").alias(f)
    return docs.select("seq", "source_ref.uri", "source_ref.version", "checksum", m("valid_from"), m("valid_to"), m("is_latest"))


@query("jn_object_asof", f"""WITH {VERSION_SQL}, q AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'hot/a.txt'
    ELSE 'src/o' || (event_id % 150) || '.md' END AS key, TIMESTAMP '2024-01-01' + to_seconds(event_id * 7919 % 400000) AS asked FROM events)
SELECT event_id, q.key, v.seq AS version_seq, v.etag FROM q LEFT JOIN oc v
  ON v.key = q.key AND v.since <= q.asked AND (v.until IS NULL OR q.asked < v.until) AND NOT v.deleted""")
def jn_object_asof(t: Tables):
    k = F.col("event_id")
    asked = t.events.select(k, F.when(k % 3 == 0, "hot/a.txt").otherwise(F.concat(F.lit("src/o"), k % 150, F.lit(".md"))).alias("key"),
                            D.at(k * 7919 % 400000).alias("at"))
    return objects.versions_as_of(asked, object_versions(t).drop("content")).select(
        "event_id", "key", F.col("found.seq").alias("version_seq"), "found.etag")


@query("src_resource_discovery", """WITH r AS (
  SELECT DISTINCT 'github' AS connector_id, 'https://github.com/' || source || '/' || lang AS resource FROM documents
  UNION ALL SELECT DISTINCT 'slack', 'slack://channel/' || conv_id || '/room-' || conv_id FROM conversations
  UNION ALL SELECT 'web', url FROM pages
  UNION ALL SELECT 'postgresql', 'postgresql://public/' || t FROM (
    SELECT DISTINCT 'events_' || event_type AS t FROM events)),
k AS (SELECT *, count(*) OVER (PARTITION BY connector_id) AS total,
  row_number() OVER (PARTITION BY connector_id ORDER BY resource) AS n FROM r)
SELECT connector_id, resource, total, total > 40 AS truncated FROM k WHERE n <= 40""")
def src_resource_discovery(t: Tables):
    answers = t.documents.groupBy("source", "lang").agg(F.to_json(F.struct(F.array(F.struct(
        F.concat_ws("/", "source", "lang").alias("full_name"))).alias("repositories"))).alias("body"))
    repos = discovery.installation_repos(answers)
    channels = t.conversations.select("conv_id").distinct()
    col, lit = F.col, F.lit
    found = discovery.resources([
        ("github", repos, F.concat(lit("https://github.com/"), col("full_name"))),
        ("slack", channels, F.concat(lit("slack://channel/"), col("conv_id"), lit("/room-"), col("conv_id"))),
        ("web", t.pages, col("url")),
        ("postgresql", t.events.select("event_type").distinct(),
         F.concat(lit("postgresql://public/events_"), col("event_type")))])
    return discovery.listed(found, 40)
