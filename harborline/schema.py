"""Table layouts and the allowed values of their enumerated columns."""

from __future__ import annotations

from pyspark.sql import types as T

SOURCE_REF = T.StructType([
    T.StructField("connector_id", T.StringType()),
    T.StructField("instance_id", T.StringType()),
    T.StructField("uri", T.StringType()),
    T.StructField("version", T.StringType()),
])

CURSOR = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("connector_id", T.StringType()),
    T.StructField("instance_id", T.StringType()),
])

# `seq` is the order in which a batch offers its documents.  It is unique
# within the batch: "first wins" and "last position" are decided on it.
RAW_DOCUMENTS = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("source_ref", SOURCE_REF),
    T.StructField("content", T.BinaryType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("checksum", T.StringType()),
    T.StructField("acquired_at", T.TimestampType()),
    T.StructField("source_metadata", T.StringType()),
    T.StructField("cursor", CURSOR),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("workspace_id", T.StringType()),
])

DOCUMENT_STATUS_LOG = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("processed_by", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])

# Names other systems exchange with ours.
JOB_STATUSES = ("PENDING", "RUNNING", "COMPLETED", "FAILED", "CANCELLED")
TERMINAL_JOB_STATUSES = ("COMPLETED", "FAILED", "CANCELLED")
DOCUMENT_STATUSES = ("PENDING", "PROCESSING", "DONE", "FAILED", "SKIPPED")
FAILURE_TYPES = ("VALIDATION", "NETWORK", "AUTH", "RATE_LIMIT", "DEDUPLICATION",
                 "REPOSITORY", "UNEXPECTED")
