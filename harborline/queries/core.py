"""Envelope, validation, de-duplication, routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions.names import mime_by_extension
from harborline.operators import dedup, envelope as env, policy, sketches, validate
from harborline.operators.filters import by_extension, by_size
from harborline.functions.names import matches_any_glob, mime_allowed
from harborline.operators.joins import mime_routes
from harborline.plans import route
from harborline.queries import derive as D
from harborline.queries.registry import Tables, query
from harborline.catalog import values as V
from harborline.session import shared_dir

REF = ["source_ref.connector_id", "source_ref.instance_id", "source_ref.uri"]


def _rule():
    return validate.default_rules(D.MAX_BYTES)


@query("flagship_route", """
WITH d AS (SELECT doc_id AS seq, sha256(source || ':doc://' || sha256(text)) AS id,
    octet_length(encode(text))::BIGINT AS n FROM documents),
r AS (SELECT n, CASE WHEN n = 0 OR n > 50000 THEN 'failed'
    WHEN seq = min(seq) FILTER (WHERE n BETWEEN 1 AND 50000) OVER (PARTITION BY id) THEN 'done'
    ELSE 'skipped' END AS status FROM d)
SELECT status, count(*) AS documents, sum(n)::BIGINT AS bytes FROM r GROUP BY status""")
def flagship_route(t: Tables):
    d = t.documents
    docs = env.envelope(
        d, connector_id="documents", instance_id=F.col("source"),
        uri=F.concat(F.lit("doc://"), F.sha2(F.encode("text", "UTF-8"), 256)),
        content=F.col("text"), content_type="text/plain", seq=F.col("doc_id"),
        acquired_at=D.at(F.col("doc_id")))
    return route.summary(route.route(docs, rule=_rule()))


@query("env_create", f"""WITH {D.CLEAN_SQL}
SELECT seq, id, connector_id, instance_id, uri, version, content_type, size_bytes, checksum,
  acquired_at, 'doc|src:' || source AS tags, source AS meta_source, seq::VARCHAR AS cursor_value
FROM clean""")
def env_create(t: Tables):
    return D.clean_documents(t).select(
        "seq", "id", *REF, "source_ref.version", "content_type", "size_bytes", "checksum",
        "acquired_at", F.array_join("tags", "|").alias("tags"),
        F.get_json_object("source_metadata", "$.source").alias("meta_source"),
        F.col("cursor.value").alias("cursor_value"))


@query("env_document_id", "SELECT doc_id, sha256(source || ':doc://' || doc_id) AS id FROM documents")
def env_document_id(t: Tables):
    return t.documents.select("doc_id", env.document_id(
        F.col("source"), F.concat(F.lit("doc://"), "doc_id")).alias("id"))


@query("env_checksum", "SELECT doc_id, sha256(text) AS checksum FROM documents")
def env_checksum(t: Tables):
    return t.documents.select("doc_id", env.checksum(F.encode("text", "UTF-8")).alias("checksum"))


@query("env_verify_integrity", f"""WITH {D.LANDED_SQL}
SELECT seq, sha256(text) = checksum AS intact FROM landed""")
def env_verify_integrity(t: Tables):
    return env.with_integrity(D.landed_documents(t)).select("seq", "intact")


@query("env_text_flag", f"""WITH {D.CLEAN_SQL}
SELECT seq, starts_with(content_type, 'text/') AS is_text,
  NOT starts_with(content_type, 'text/') AS is_binary FROM clean""")
def env_text_flag(t: Tables):
    return env.with_text_flag(D.clean_documents(t)).select("seq", "is_text", "is_binary")


# Paths with a spread of extensions, dots in folders, and none at all.
EXTS = ("py", "md", "json", "PNG", "log", "tmp", "pdf", "xyz", "gz", "html")


def paths(t: Tables):
    n = F.col("doc_id") % (len(EXTS) + 1)
    ext = F.element_at(F.array(*map(F.lit, EXTS)), (F.least(n, F.lit(len(EXTS) - 1)) + 1).cast("int"))
    name = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return t.documents.select(
        "doc_id", "n_chars", F.octet_length("text").cast("bigint").alias("size"), "text",
        F.when(n == len(EXTS), F.concat(F.lit("v1.2/"), name))
        .otherwise(F.concat(name, F.lit("."), ext)).alias("path"))


PATHS_SQL = f"""
paths AS (
  SELECT doc_id, octet_length(encode(text))::BIGINT AS size, text, source,
    CASE WHEN doc_id % {len(EXTS) + 1} = {len(EXTS)} THEN 'v1.2/' || source || '/' || lang || '/' || doc_id
    ELSE source || '/' || lang || '/' || doc_id || '.' ||
      ({list(EXTS)!r})[(doc_id % {len(EXTS) + 1})::INT + 1] END AS path FROM documents),
exts AS (
  SELECT *, CASE WHEN contains(path, '.') THEN '.' || lower(split_part(path, '.', -1)) ELSE '' END AS ext
  FROM paths)"""


@query("env_mime_by_ext", f"""WITH {PATHS_SQL}
SELECT doc_id, CASE ext WHEN '.py' THEN 'text/x-python' WHEN '.md' THEN 'text/markdown'
  WHEN '.json' THEN 'application/json' WHEN '.png' THEN 'image/png' WHEN '.log' THEN 'text/plain'
  WHEN '.pdf' THEN 'application/pdf' WHEN '.html' THEN 'text/html'
  ELSE 'application/octet-stream' END AS content_type FROM exts""")
def env_mime_by_ext(t: Tables):
    return paths(t).select("doc_id", mime_by_extension(F.col("path")).alias("content_type"))


@query("flt_extension", f"""WITH {PATHS_SQL}
SELECT doc_id, path FROM exts WHERE ext NOT IN ('.tmp', '.log', '.lock', '.pyc')
  AND ext IN ('.py', '.md', '.json', '.png', '.log')""")
def flt_extension(t: Tables):
    keep = by_extension(F.col("path"), V.OBJECT_EXCLUDED_EXTENSIONS,
                        (".py", ".md", ".json", ".png", ".log"))
    return paths(t).where(keep).select("doc_id", "path")


@query("flt_size", f"WITH {PATHS_SQL} SELECT doc_id, size FROM paths WHERE size > 0 AND size <= 2000")
def flt_size(t: Tables):
    return paths(t).where(by_size(F.col("size"), 2000)).select("doc_id", "size")


@query("flt_glob", f"""WITH {PATHS_SQL}
SELECT doc_id, path FROM paths WHERE path GLOB 'src1*/*.md' OR path GLOB '*/[df]?/*5.py'""")
def flt_glob(t: Tables):
    return paths(t).where(matches_any_glob(F.col("path"), ["src1*/*.md", "*/[df]?/*5.py"])) \
        .select("doc_id", "path")


@query("flt_mime_allowed", f"""WITH {D.CLEAN_SQL}
SELECT seq, content_type FROM clean WHERE content_type = 'application/json'
  OR split_part(content_type, '/', 1) || '/*' IN ('application/json', 'image/*')
  OR content_type = 'text/html'""")
def flt_mime_allowed(t: Tables):
    allowed = ["application/json", "image/*", "text/html"]
    return D.clean_documents(t).where(mime_allowed(F.col("content_type"), allowed)) \
        .select("seq", "content_type")


@query("val_schema", f"""WITH {D.LANDED_SQL}
SELECT seq, CASE WHEN instance_id = '' OR uri = '' OR content_type = '' THEN 'MissingRequiredFieldError'
    WHEN length(id) <> 64 THEN 'SchemaValidationError' END AS error_type,
  CASE WHEN instance_id = '' THEN 'source_ref.instance_id' WHEN uri = '' THEN 'source_ref.uri'
    WHEN content_type = '' THEN 'content_type' WHEN length(id) <> 64 THEN 'id' END AS error_field
FROM landed""")
def val_schema(t: Tables):
    return validate.validated(D.landed_documents(t), validate.schema_rule()).select(
        "seq", "error.error_type", "error.error_field")


@query("val_content", f"""WITH {D.LANDED_SQL}
SELECT seq, CASE WHEN text = '' THEN 'EmptyContentError' WHEN size_bytes > 50000 THEN 'SizeLimitError'
  WHEN sha256(text) <> checksum THEN 'ChecksumMismatchError' END AS error_type FROM landed""")
def val_content(t: Tables):
    return validate.validated(D.landed_documents(t), validate.content_rule(D.MAX_BYTES)).select(
        "seq", "error.error_type")


@query("val_mime", f"""WITH {D.LANDED_SQL}
SELECT seq, CASE WHEN content_type = '' OR (content_type <> 'application/json'
    AND NOT starts_with(content_type, 'text/')) THEN 'InvalidContentTypeError' END AS error_type,
  CASE WHEN content_type = '' OR (content_type <> 'application/json'
    AND NOT starts_with(content_type, 'text/')) THEN
    'Content type ''' || content_type || ''' is not accepted. Allowed: application/json, text/*' END AS message
FROM landed""")
def val_mime(t: Tables):
    return validate.validated(D.landed_documents(t),
                              validate.mime_rule(["application/json", "text/*"])).select(
        "seq", "error.error_type", "error.message")


@query("val_first_failure", f"""WITH {D.CHECKED_SQL}
SELECT seq, error_type, error_field, message FROM worded""")
def val_first_failure(t: Tables):
    return validate.validated(D.landed_documents(t), _rule()).select("seq", "error.*")


@query("val_error_report", f"""WITH {D.CHECKED_SQL}
SELECT error_type, error_field, connector_id, count(*) AS rejected FROM worded
WHERE error_type IS NOT NULL GROUP BY ALL""")
def val_error_report(t: Tables):
    return validate.error_report(validate.validated(D.landed_documents(t), _rule()))


def content_policies(t: Tables):
    """A policy per customer, of every kind that has a key, and one in a hundred
    without; documents of 40 hosts below nine domains."""
    k = F.col("c_custkey")
    kind = k % 8
    rows = t.customer.select(
        k.alias("policy_id"), F.when(k % 5 == 0, "c1").otherwise("*").alias("scope"),
        F.when(k % 100 == 7, F.element_at(F.array(*map(F.lit, ("uri", "uri", "size_bytes", "tag"))), (F.floor(k / 100) % 4 + 1).cast("int")))
        .when(kind < 2, "domain").when(kind == 2, "content_type").when(kind == 3, "tag").when(kind == 4, "workspace_id")
        .when(kind == 5, "extension").otherwise("domain").alias("field"),
        F.when(k % 100 == 7, F.element_at(F.array(*map(F.lit, ("contains", "regex", "gt", "prefix"))), (F.floor(k / 100) % 4 + 1).cast("int")))
        .when(kind == 4, "in").when(kind.isin(1, 6, 7), "suffix").otherwise("eq").alias("operator"),
        F.when(k % 100 == 7, F.element_at(F.array(
            F.concat(F.lit("/a"), k % 13, F.lit("/")), F.concat(F.lit("/[0-9]*"), k % 10, F.lit("[.]md[?]")),
            (k * 3 + 9000).cast("string"), F.concat(F.lit("src:src"), k % 30)), (F.floor(k / 100) % 4 + 1).cast("int")))
        .when(kind == 0, F.concat(F.lit("H"), k % 400, F.lit(".d"), k % 9, F.lit(".example.com")))
        .when(kind == 1, F.concat(F.lit(".d"), k % 90, F.lit(".example.com")))
        .when(kind == 2, F.when(k % 3 == 0, "text/html").otherwise("image/png"))
        .when(kind == 3, F.concat(F.lit("src:src"), k % 40))
        .when(kind == 4, F.concat(F.lit("src"), k % 70, F.lit(", src"), k % 90))
        .when(kind == 5, F.when(k % 2 == 0, ".md").otherwise(".exe"))
        .otherwise(F.concat(F.lit("x"), k, F.lit(".org"))).alias("value"),
        F.when(k % 3 == 1, "allow").otherwise("reject").alias("action"), (k * 7 % 50).cast("int").alias("priority"))
    return rows


def policed_documents(t: Tables):
    k = F.col("doc_id")
    return env.envelope(
        t.documents, connector_id=F.concat(F.lit("c"), k % 3), instance_id=F.col("lang"),
        uri=F.concat(F.lit("https://h"), k % 40, F.lit(".d"), k % 9, F.lit(".Example.com:8080/a"), k % 17, F.lit("/"), k, F.lit(".md?q=.x")),
        content=F.col("text"), content_type=F.when(k % 4 == 0, "text/html").otherwise("text/plain"), seq=k,
        tags=["doc", F.concat(F.lit("src:"), F.col("source"))], workspace_id=F.col("source"))


POLICY_SQL = r"""p AS (SELECT c_custkey AS policy_id, CASE WHEN c_custkey % 5 = 0 THEN 'c1' ELSE '*' END AS scope,
  CASE WHEN c_custkey % 100 = 7 THEN 10 + c_custkey // 100 % 4 ELSE c_custkey % 8 END AS kind, c_custkey AS k,
  CASE WHEN c_custkey % 3 = 1 THEN 'allow' ELSE 'reject' END AS action, (c_custkey * 7 % 50)::INT AS priority FROM customer),
d AS (SELECT doc_id AS seq, 'c' || (doc_id % 3) AS connector, 'h' || (doc_id % 40) || '.d' || (doc_id % 9) || '.example.com' AS domain,
  'https://h' || (doc_id % 40) || '.d' || (doc_id % 9) || '.Example.com:8080/a' || (doc_id % 17) || '/' || doc_id || '.md?q=.x' AS uri,
  CASE WHEN doc_id % 4 = 0 THEN 'text/html' ELSE 'text/plain' END AS mime, source, octet_length(encode(text)) AS size FROM documents),
hit AS (SELECT seq, policy_id, action, priority FROM d JOIN p ON (scope = '*' OR scope = connector) AND CASE kind
  WHEN 0 THEN domain = 'h' || (k % 400) || '.d' || (k % 9) || '.example.com'
  WHEN 1 THEN ends_with('.' || domain, '.d' || (k % 90) || '.example.com')
  WHEN 2 THEN mime = CASE WHEN k % 3 = 0 THEN 'text/html' ELSE 'image/png' END
  WHEN 3 THEN source = 'src' || (k % 40)
  WHEN 4 THEN source IN ('src' || (k % 70), 'src' || (k % 90))
  WHEN 5 THEN k % 2 = 0
  WHEN 10 THEN contains(uri, '/a' || (k % 13) || '/')
  WHEN 11 THEN regexp_matches(uri, '/[0-9]*' || (k % 10) || '[.]md[?]')
  WHEN 12 THEN size > k * 3 + 9000
  WHEN 13 THEN starts_with('src:' || source, 'src:src' || (k % 30))
  ELSE false END)"""


@query("val_policy", f"""WITH {POLICY_SQL}
SELECT seq, policy_id, action, priority, CASE WHEN action = 'reject' THEN 'ContentPolicyError' END AS error_type,
  CASE WHEN action = 'reject' THEN 'Content policy violation: policy ' || policy_id END AS message
FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY priority DESC, policy_id) AS n FROM hit) WHERE n = 1""")
def val_policy(t: Tables):
    return policy.decisions(policed_documents(t), content_policies(t)).select(
        "seq", "policy_id", "action", "priority", "error.error_type", "error.message")


@query("ext_validator", f"""WITH {D.LANDED_SQL}
SELECT seq, CASE WHEN instance_id = '' OR uri = '' OR content_type = '' THEN 'MissingRequiredFieldError'
    WHEN length(id) <> 64 THEN 'SchemaValidationError'
    WHEN length(text) < 200 THEN 'TooShort' END AS error_type FROM landed""")
def ext_validator(t: Tables):
    def short(df):
        return F.when(F.length(F.col("content").cast("string")) < 200,
                      validate.error("TooShort", "fewer than 200 characters", "content"))

    rule = lambda df: validate.first_failure(validate.schema_rule(), short(df))
    return validate.validated(D.landed_documents(t), rule).select("seq", "error.error_type")


def _checked(t: Tables):
    return route.thin(D.landed_documents(t), _rule())


@query("dd_batch", f"""WITH {D.ROUTED_SQL} SELECT seq, id FROM routed WHERE status = 'done'""")
def dd_batch(t: Tables):
    return dedup.keep_first(_checked(t), ["id"], valid=F.col("error").isNull()).select("seq", "id")


@query("dd_repository", f"""WITH {D.CLEAN_SQL}{D.STORED_SQL}
SELECT seq, id FROM clean WHERE id NOT IN (SELECT id FROM stored)""")
def dd_repository(t: Tables):
    return dedup.drop_known(D.clean_documents(t).select("seq", "id"), D.stored_ids(t)) \
        .select("seq", "id")


@query("dd_two_tier", f"""WITH {D.ROUTED_SQL}{D.STORED_SQL}
SELECT seq, id FROM routed WHERE status = 'done' AND id NOT IN (SELECT id FROM stored)""")
def dd_two_tier(t: Tables):
    return dedup.two_tier(_checked(t), D.stored_ids(t), valid=F.col("error").isNull()) \
        .select("seq", "id")


@query("dd_content_hash", """WITH d AS (SELECT doc_id AS seq, source, sha256(text) AS checksum,
    sha256(source || ':' || doc_id) AS id FROM documents)
SELECT seq, checksum, row_number() OVER (PARTITION BY checksum ORDER BY seq) = 1 AS is_first FROM d""")
def dd_content_hash(t: Tables):
    docs = env.envelope(t.documents, connector_id="documents", instance_id=F.col("source"),
                        uri=F.col("doc_id").cast("string"), content=F.col("text"),
                        content_type="text/plain", seq=F.col("doc_id"),
                        acquired_at=D.at(F.col("doc_id")))
    return dedup.same_content(docs.select("seq", "id", "checksum", "acquired_at")) \
        .select("seq", "checksum", "is_first")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("dd_near_batches", rf"""WITH d AS (SELECT doc_id, doc_id % 2 AS batch,
  regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, batch, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS shingle
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS cc FROM s a JOIN s b USING (shingle)
  WHERE (b.batch, b.doc_id) < (a.batch, a.doc_id) GROUP BY ALL)
SELECT doc_id, batch::INT AS batch, doc_id IN (SELECT x FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 10 * cc >= 8 * (p.n + q.n - cc)) AS near_duplicate FROM d""")
def dd_near_batches(t: Tables):
    index = sketches.SketchIndex(t.spark, shared_dir(t.spark, "sketches"))
    out = None
    for batch in (0, 1):
        docs = t.documents.where(F.col("doc_id") % 2 == batch).select(F.col("doc_id").alias("seq"), F.col("doc_id").alias("id"), "text")
        told = index.add(docs, batch).select(F.col("seq").alias("doc_id"), F.lit(batch).alias("batch"), "near_duplicate")
        out = told if out is None else out.unionByName(told)
    return out


@query("ext_deduplicator", f"""WITH {D.CLEAN_SQL}
SELECT seq, uri FROM clean QUALIFY row_number() OVER (
  PARTITION BY upper(text), content_type ORDER BY seq) = 1""")
def ext_deduplicator(t: Tables):
    rows = D.clean_documents(t).select(
        "seq", "source_ref.uri", "content_type",
        F.upper(F.col("content").cast("string")).alias("spelling"))
    return dedup.keep_first(rows, ["spelling", "content_type"]).select("seq", "uri")


@query("jn_mime_route", f"""WITH {D.CLEAN_SQL},
manifest(connector_id, mime) AS (VALUES {', '.join(f"('{c}', '{m}')" for c, ms in V.SOURCE_MIME.items() for m in ms)})
SELECT DISTINCT seq, m.connector_id FROM clean c, manifest m
WHERE m.mime IN ('*/*', c.content_type, split_part(c.content_type, '/', 1) || '/*')""")
def jn_mime_route(t: Tables):
    manifest = t.spark.createDataFrame(
        [(c, m) for c, ms in V.SOURCE_MIME.items() for m in ms], "connector_id string, mime string")
    return mime_routes(D.clean_documents(t).select("seq", "content_type"), manifest) \
        .select("seq", "connector_id")


@query("pipe_route", f"""WITH {D.ROUTED_SQL}{D.STORED_SQL}
SELECT seq, id, CASE WHEN status = 'done' AND id IN (SELECT id FROM stored) THEN 'skipped'
    ELSE status END AS status,
  CASE WHEN status = 'failed' THEN message
    WHEN status = 'skipped' OR id IN (SELECT id FROM stored) THEN 'duplicate' ELSE '' END AS reason
FROM routed""")
def pipe_route(t: Tables):
    return route.route(D.landed_documents(t), D.stored_ids(t), _rule()).select(
        "seq", "id", "status", "reason")


@query("agg_cycle_result", f"""WITH {D.ROUTED_SQL}
SELECT count(*) AS found, count(*) FILTER (status = 'done') AS processed,
  count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed,
  count(*) FILTER (status = 'failed') = 0 AS success, count(*) > 0 AS has_work FROM routed""")
def agg_cycle_result(t: Tables):
    return route.cycle_result(route.route(D.landed_documents(t), rule=_rule()))
