"""Landed rows derived from the driver's tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.operators.envelope import envelope
from harborline.queries.registry import Tables

EPOCH = "2024-01-01 00:00:00"


def at(seconds: Column) -> Column:
    """Timestamp `seconds` after EPOCH (session zone is UTC)."""
    return F.timestamp_seconds(F.lit(1704067200) + seconds)


# Every 50 documents carry six defects; texts above MAX_BYTES are too large.
MAX_BYTES = 50_000


def clean_documents(t: Tables) -> DataFrame:
    d = t.documents
    return envelope(
        d, connector_id=F.concat(F.lit("c"), F.col("doc_id") % 3), instance_id=F.col("lang"),
        uri=F.concat(F.lit("doc://"), F.sha2(F.encode("text", "UTF-8"), 256)),
        content=F.col("text"),
        content_type=F.when(F.col("doc_id") % 4 == 0, "text/html")
        .when(F.col("doc_id") % 4 == 1, "application/json").otherwise("text/plain"),
        seq=F.col("doc_id"), version=F.col("n_chars"), cursor_value=F.col("doc_id"),
        cursor_type="sequence", tags=["doc", F.concat(F.lit("src:"), F.col("source"))],
        metadata=F.struct("source", "n_chars"), acquired_at=at(F.col("doc_id")),
        workspace_id=F.col("source"))


def landed_documents(t: Tables) -> DataFrame:
    """`clean_documents` with defects, so that every validation rule fires."""
    k = F.col("seq") % 50
    ref = F.col("source_ref")
    return (clean_documents(t)
            .withColumn("content", F.when(k == 3, F.lit("").cast("binary"))
                        .otherwise(F.col("content")))
            .withColumn("checksum", F.when(k == 11, F.reverse("checksum"))
                        .otherwise(F.col("checksum")))
            .withColumn("content_type", F.when(k == 19, "").otherwise(F.col("content_type")))
            .withColumn("id", F.when(k == 27, F.substring("id", 1, 12)).otherwise(F.col("id")))
            .withColumn("source_ref", F.struct(
                ref["connector_id"].alias("connector_id"),
                F.when(k == 43, "").otherwise(ref["instance_id"]).alias("instance_id"),
                F.when(k == 35, "").otherwise(ref["uri"]).alias("uri"),
                ref["version"].alias("version"))))


CLEAN_SQL = """
clean AS (
  SELECT doc_id AS seq, 'c' || (doc_id % 3) AS connector_id, lang AS instance_id,
    'doc://' || sha256(text) AS uri, sha256(lang || ':' || 'doc://' || sha256(text)) AS id,
    text, CASE doc_id % 4 WHEN 0 THEN 'text/html' WHEN 1 THEN 'application/json'
      ELSE 'text/plain' END AS content_type,
    octet_length(encode(text))::BIGINT AS size_bytes, sha256(text) AS checksum,
    TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS acquired_at,
    n_chars::VARCHAR AS version, source, source AS workspace_id
  FROM documents)"""

LANDED_SQL = CLEAN_SQL + """,
landed AS (
  SELECT seq, connector_id, CASE WHEN seq % 50 = 43 THEN '' ELSE instance_id END AS instance_id,
    CASE WHEN seq % 50 = 35 THEN '' ELSE uri END AS uri,
    CASE WHEN seq % 50 = 27 THEN substr(id, 1, 12) ELSE id END AS id,
    CASE WHEN seq % 50 = 3 THEN '' ELSE text END AS text,
    CASE WHEN seq % 50 = 19 THEN '' ELSE content_type END AS content_type, size_bytes,
    CASE WHEN seq % 50 = 11 THEN reverse(checksum) ELSE checksum END AS checksum,
    acquired_at, version
  FROM clean)"""

# First failing rule, in order.
CHECKED_SQL = LANDED_SQL + f""",
checked AS (
  SELECT *, CASE
      WHEN id = '' THEN 'MissingRequiredFieldError' WHEN connector_id = '' THEN 'MissingRequiredFieldError'
      WHEN instance_id = '' THEN 'MissingRequiredFieldError' WHEN uri = '' THEN 'MissingRequiredFieldError'
      WHEN content_type = '' THEN 'MissingRequiredFieldError'
      WHEN length(id) <> 64 THEN 'SchemaValidationError'
      WHEN text = '' THEN 'EmptyContentError' WHEN size_bytes > {MAX_BYTES} THEN 'SizeLimitError'
      WHEN sha256(text) <> checksum THEN 'ChecksumMismatchError' END AS error_type,
    CASE WHEN instance_id = '' THEN 'source_ref.instance_id' WHEN uri = '' THEN 'source_ref.uri'
      WHEN content_type = '' THEN 'content_type' WHEN length(id) <> 64 THEN 'id' END AS error_field
  FROM landed),
worded AS (
  SELECT *, CASE error_type
      WHEN 'MissingRequiredFieldError' THEN 'Required field ''' || error_field || ''' is missing or null'
      WHEN 'SchemaValidationError' THEN 'Schema validation failed on field ''id'': must be 64-char hex SHA-256'
      WHEN 'EmptyContentError' THEN 'Document content is empty'
      WHEN 'SizeLimitError' THEN 'Document size ' || format('{{:,}}', size_bytes) || ' bytes exceeds limit of 50,000 bytes'
      WHEN 'ChecksumMismatchError' THEN 'Checksum mismatch — document may be corrupted' END AS message
  FROM checked)"""

ROUTED_SQL = CHECKED_SQL + """,
routed AS (
  SELECT *, CASE WHEN error_type IS NOT NULL THEN 'failed'
      WHEN seq = min(seq) FILTER (WHERE error_type IS NULL) OVER (PARTITION BY id) THEN 'done'
      ELSE 'skipped' END AS status
  FROM worded)"""

# The repository before the batch: documents of one source.
STORED_SQL = """,
stored AS (SELECT DISTINCT id FROM clean WHERE source = 'src1')"""


def stored_ids(t: Tables) -> DataFrame:
    docs = clean_documents(t)
    return docs.where(F.col("workspace_id") == "src1").select("id").distinct()
