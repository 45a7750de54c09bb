"""Validation rules as nullable error structs.

A rule is a Column: null when the row is fine, else
`struct<error_type, error_field, message>`.  `first_failure` is `coalesce`, so
rules run in order and the first hit decides, without leaving codegen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from harborline.catalog import values as V
from harborline.functions.names import mime_allowed
from harborline.operators.envelope import intact
from harborline.session import once

ERROR = "struct<error_type:string,error_field:string,message:string>"

Rule = Callable[[DataFrame], Column]


def error(error_type: str, message: Column | str, field: str | None = None) -> Column:
    text = message if isinstance(message, Column) else F.lit(message)
    return F.struct(F.lit(error_type).alias("error_type"),
                    F.lit(field).cast("string").alias("error_field"),
                    text.alias("message")).cast(ERROR)


def _blank(c: Column) -> Column:
    return c.isNull() | (F.length(c) == 0)


def schema_rule() -> Column:
    """Required fields in order, then the id's length."""
    required = ["id", "source_ref.connector_id", "source_ref.instance_id", "source_ref.uri",
                "content_type"]
    found = F.when(F.lit(False), F.lit(None).cast(ERROR))
    for name in required:
        found = found.when(_blank(F.col(name)), error(
            "MissingRequiredFieldError", f"Required field '{name}' is missing or null", name))
    return (found
            .when(F.col("acquired_at").isNull(), error(
                "MissingRequiredFieldError", "Required field 'acquired_at' is missing or null",
                "acquired_at"))
            .when(F.length("id") != 64, error(
                "SchemaValidationError",
                "Schema validation failed on field 'id': must be 64-char hex SHA-256", "id")))


def content_rule(max_bytes: int = V.MAX_DOCUMENT_BYTES) -> Column:
    """Empty, too large, altered; the hash is only computed when the cheap
    tests pass."""
    too_big = F.concat(F.lit("Document size "), F.format_number("size_bytes", 0),
                       F.lit(f" bytes exceeds limit of {max_bytes:,} bytes"))
    return (F.when(F.col("content").isNull() | (F.octet_length("content") == 0),
                   error("EmptyContentError", "Document content is empty"))
            .when(F.col("size_bytes") > max_bytes, error("SizeLimitError", too_big))
            .when(~intact(F.col("content"), F.col("checksum")),
                  error("ChecksumMismatchError",
                        "Checksum mismatch — document may be corrupted")))


def mime_rule(allowed) -> Column:
    if allowed is None:
        return F.lit(None).cast(ERROR)
    text = F.concat(F.lit("Content type '"), F.col("content_type"),
                    F.lit("' is not accepted. Allowed: " + ", ".join(allowed)))
    return F.when(~mime_allowed(F.col("content_type"), allowed),
                  error("InvalidContentTypeError", text))


def first_failure(*rules: Column) -> Column:
    return F.coalesce(*rules)


def default_rules(max_bytes: int = V.MAX_DOCUMENT_BYTES) -> Column:
    return first_failure(schema_rule(), content_rule(max_bytes))


def validated(docs: DataFrame, rule: Column | Rule | None = None) -> DataFrame:
    """`docs` plus `error`; a user rule is a Column or DataFrame -> Column."""
    if rule is None:
        rule = default_rules()
    elif not isinstance(rule, Column):
        rule = rule(docs)
    return once(docs, "error", rule)


def error_report(checked: DataFrame) -> DataFrame:
    return (checked.where("error is not null")
            .groupBy(F.col("error.error_type").alias("error_type"),
                     F.col("error.error_field").alias("error_field"),
                     F.col("source_ref.connector_id").alias("connector_id"))
            .agg(F.count("*").alias("rejected")))
