"""The canonical document envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.functions.classify import is_text


def document_id(instance_id: Column, uri: Column) -> Column:
    return F.sha2(F.concat(instance_id, F.lit(":"), uri), 256)


def checksum(content: Column) -> Column:
    return F.sha2(content, 256)


def intact(content: Column, expected: Column) -> Column:
    return checksum(content) == expected


def cursor_of(value: Column, source_type: str, connector_id: Column,
              instance_id: Column) -> Column:
    return F.struct(value.cast("string").alias("value"), F.lit(source_type).alias("source_type"),
                    connector_id.alias("connector_id"), instance_id.alias("instance_id"))


def envelope(df: DataFrame, *, connector_id: Column | str, instance_id: Column, uri: Column,
             content: Column, content_type: Column | str, seq: Column,
             version: Column | None = None, cursor_value: Column | None = None,
             cursor_type: str = "timestamp", tags: list[Column | str] = (),
             metadata: Column | None = None, acquired_at: Column | None = None,
             workspace_id: Column | None = None, withheld: Column | None = None) -> DataFrame:
    """Project landed rows to `RAW_DOCUMENTS`.

    `withheld` counts bytes that belong to a document but weren't gathered,
    because it is above the document limit anyway.  They count in its size, so
    validation rejects it, with that size, instead of storing what is left.

    `content` may be text or binary; derived fields (id, size, checksum) are
    computed here and nowhere else.  One narrow projection, no shuffle.
    """
    as_col = lambda c: c if isinstance(c, Column) else F.lit(c)
    connector_id, content_type = as_col(connector_id), as_col(content_type)
    base = df.select(
        seq.cast("bigint").alias("seq"),
        connector_id.alias("_connector"), instance_id.alias("_instance"), uri.alias("_uri"),
        (version if version is not None else F.lit(None)).cast("string").alias("_version"),
        content.cast("binary").alias("content"), content_type.alias("content_type"),
        (acquired_at if acquired_at is not None else F.current_timestamp())
        .cast("timestamp").alias("acquired_at"),
        (F.to_json(metadata) if metadata is not None else F.lit("{}")).alias("source_metadata"),
        (cursor_value if cursor_value is not None else F.lit(None)).cast("string").alias("_pos"),
        (F.array(*[as_col(t) for t in tags]) if len(tags)
         else F.array().cast("array<string>")).alias("tags"),
        (workspace_id if workspace_id is not None else F.lit(None)).cast("string")
        .alias("workspace_id"),
        (F.coalesce(withheld, F.lit(0)) if withheld is not None else F.lit(0)).cast("bigint").alias("_withheld"),
    )
    cursor = F.when(F.col("_pos").isNotNull(),
                    cursor_of(F.col("_pos"), cursor_type, F.col("_connector"), F.col("_instance")))
    return base.select(
        "seq",
        document_id(F.col("_instance"), F.col("_uri")).alias("id"),
        F.struct(F.col("_connector").alias("connector_id"), F.col("_instance").alias("instance_id"),
                 F.col("_uri").alias("uri"), F.col("_version").alias("version")).alias("source_ref"),
        "content", "content_type",
        (F.octet_length("content") + F.col("_withheld")).alias("size_bytes"),
        checksum(F.col("content")).alias("checksum"),
        "acquired_at", "source_metadata", cursor.alias("cursor"), "tags", "workspace_id")


def with_integrity(docs: DataFrame) -> DataFrame:
    return docs.withColumn("intact", intact(F.col("content"), F.col("checksum")))


def with_text_flag(docs: DataFrame) -> DataFrame:
    return (docs.withColumn("is_text", is_text(F.col("content_type")))
            .withColumn("is_binary", ~is_text(F.col("content_type"))))
