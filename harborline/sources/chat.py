"""Chat history, files, channels, members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.functions.names import mime_by_object_key
from harborline.operators.envelope import envelope
from harborline.operators.filters import file_present, member_active, message_wanted
from harborline.operators.joins import thread_replies
from harborline.operators.ordered import limit_per_key
from harborline.sources.common import KEEP_NULLS, meta, tag, text_or

MESSAGE = ("ts string, user string, bot_id string, text string, type string, subtype string, "
           "thread_ts string, reply_count int, reactions array<string>, "
           "attachments array<string>, blocks array<string>")


def messages(rows: DataFrame, instance_id: str, *, include_bots: bool = False,
             include_threads: bool = True, oldest: str | None = None,
             per_channel: int | None = None, seq: Column | None = None) -> DataFrame:
    """Messages (channel_id + MESSAGE fields) -> JSON documents.

    Replies are attached before the envelope is built, so size and checksum
    describe the stored content.
    """
    col = F.col
    kept = rows.where(message_wanted(col("bot_id"), col("subtype"), include_bots))
    if oldest:
        kept = kept.where(col("ts") > oldest)
    if per_channel:
        kept = limit_per_key(kept, ["channel_id"], ["ts"], per_channel)
    if include_threads:
        threads = thread_replies(rows).select("channel_id", "ts", "replies")
        kept = kept.join(threads, ["channel_id", "ts"], "left")
    else:
        kept = kept.withColumn("replies", F.lit(None).cast(
            "array<struct<user:string,text:string,ts:string>>"))
    none = F.array().cast("array<string>")
    user = F.coalesce(col("user"), col("bot_id"), F.lit(""))
    replies = F.coalesce(col("reply_count"), F.lit(0))
    fields = [
        col("ts"), col("channel_id"), user.alias("user"), text_or(col("text")).alias("text"),
        text_or(col("type"), "message").alias("type"), col("subtype"),
        F.coalesce("reactions", none).alias("reactions"),
        F.coalesce("attachments", none).alias("attachments"),
        F.coalesce("blocks", none).alias("blocks"), col("thread_ts"),
        replies.alias("reply_count")]
    plain = F.to_json(F.struct(*fields), KEEP_NULLS)
    threaded = F.to_json(F.struct(*fields, col("replies")), KEEP_NULLS)
    content = F.when(F.size("replies") > 0, threaded).otherwise(plain)
    return envelope(
        kept, connector_id="slack", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit("slack://message/"), col("channel_id"), F.lit("/"), col("ts")),
        content=content, content_type="application/json",
        seq=seq if seq is not None else F.monotonically_increasing_id(), version=col("ts"),
        cursor_value=col("ts"), tags=["message", tag("channel:", col("channel_id"))],
        metadata=meta(resource_type=F.lit("message"), channel_id=col("channel_id"), ts=col("ts"),
                      user=user, has_thread=replies > 0))


def files(meta_rows: DataFrame, blobs: DataFrame, instance_id: str, since_ts: int = 0,
          seq: Column | None = None) -> DataFrame:
    """File metadata (id, name, mimetype, mode, timestamp, filetype, size,
    user) joined to landed bytes (id, content) -> documents."""
    col = F.col
    wanted = meta_rows.where(file_present(col("mode")) & (col("timestamp") >= since_ts))
    rows = wanted.join(blobs.select("id", "content"), "id")
    guessed = mime_by_object_key(col("name"))
    stamp = text_or(col("timestamp").cast("string"))
    return envelope(
        rows, connector_id="slack", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit("slack://file/"), col("id"), F.lit("/"), col("name")),
        content=col("content"), content_type=F.coalesce(F.nullif("mimetype", F.lit("")), guessed),
        seq=seq if seq is not None else F.monotonically_increasing_id(), version=stamp,
        cursor_value=stamp, tags=["file", tag("type:", text_or(col("filetype"), "unknown"))],
        metadata=meta(resource_type=F.lit("file"), file_id=col("id"), name=col("name"),
                      size=col("size"), filetype=col("filetype"), user=text_or(col("user")),
                      timestamp=col("timestamp")))


def channels(rows: DataFrame, instance_id: str, seq: Column | None = None) -> DataFrame:
    """Channel metadata (id, name, ...) -> JSON documents."""
    return envelope(
        rows, connector_id="slack", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit("slack://channel/"), F.col("id")),
        content=F.to_json(F.struct(*rows.columns), KEEP_NULLS), content_type="application/json",
        seq=seq if seq is not None else F.monotonically_increasing_id(), tags=["channel"],
        metadata=F.struct(F.lit("channel").alias("resource_type"), *[F.col(c) for c in rows.columns]))


def users(rows: DataFrame, instance_id: str, seq: Column | None = None) -> DataFrame:
    """Members (id, name, real_name, email, deleted, is_bot, updated) -> JSON
    documents; deleted members and bots are left out."""
    col = F.col
    kept = rows.where(member_active(col("deleted"), col("is_bot")))
    return envelope(
        kept, connector_id="slack", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit("slack://user/"), col("id")),
        content=F.to_json(F.struct(*rows.columns), KEEP_NULLS), content_type="application/json",
        seq=seq if seq is not None else F.monotonically_increasing_id(),
        version=text_or(col("updated").cast("string")), tags=["user"],
        metadata=meta(resource_type=F.lit("user"), user_id=col("id"), name=text_or(col("name")),
                      real_name=text_or(col("real_name")), email=text_or(col("email"))))
