"""RSS 2.0 and Atom 1.0 feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harborline.functions.codec import feed_epoch
from harborline.operators.envelope import envelope
from harborline.sources.common import meta, text_or

_ITEM = ("array<struct<title:string,link:string,description:string,author:string,pubDate:string>>")
RSS = f"channel struct<item:{_ITEM}>, item {_ITEM}"
ATOM = ("entry array<struct<title:string,id:string,updated:string,"
        "link:array<struct<_href:string,_VALUE:string>>,"
        "content:struct<_VALUE:string,_type:string>,summary:struct<_VALUE:string,_type:string>>>")

ITEM_COLUMNS = ("title", "link", "id", "content", "author", "published")


def read_items(spark: SparkSession, path: str, feed_url: Column | None = None) -> DataFrame:
    """RSS items of feed files, split by the XML source itself, so that one
    huge feed file is read by several tasks."""
    rows = (spark.read.format("xml").option("rowTag", "item")
            .schema("title string, link string, description string, author string, pubDate string")
            .load(path))
    return rows.select(
        (feed_url if feed_url is not None else F.col("_metadata.file_path")).alias("feed_url"),
        text_or(F.col("title")).alias("title"), text_or(F.col("link")).alias("link"),
        F.lit("").alias("id"), text_or(F.col("description")).alias("content"),
        text_or(F.col("author")).alias("author"), text_or(F.col("pubDate")).alias("published"),
    ).withColumn("published_ts", feed_epoch(F.col("published")))


def feed_items(feeds: DataFrame) -> DataFrame:
    """Landed feeds (feed_url, xml, ...) -> normalised items of both formats.
    Unreadable XML yields nothing."""
    keep = [c for c in feeds.columns if c != "xml"]
    root = F.regexp_extract("xml", r"<([A-Za-z][\w:.\-]*)[\s>]", 1)
    xml = F.col("xml")
    rss = (feeds.where(root != "feed").withColumn("r", F.from_xml(xml, RSS))
           .withColumn("_items", F.concat(
               F.coalesce("r.channel.item", F.array().cast(_ITEM)),
               F.coalesce("r.item", F.array().cast(_ITEM))))
           .select(*keep, F.posexplode("_items").alias("item_no", "i"))
           .select(*keep, "item_no", text_or(F.col("i.title")).alias("title"),
                   text_or(F.col("i.link")).alias("link"), F.lit("").alias("id"),
                   text_or(F.col("i.description")).alias("content"),
                   text_or(F.col("i.author")).alias("author"),
                   text_or(F.col("i.pubDate")).alias("published")))
    atom = (feeds.where(root == "feed").withColumn("r", F.from_xml(xml, ATOM))
            .select(*keep, F.posexplode("r.entry").alias("item_no", "e"))
            .select(*keep, "item_no", text_or(F.col("e.title")).alias("title"),
                    text_or(F.get(F.col("e.link"), 0)["_href"]).alias("link"),
                    text_or(F.col("e.id")).alias("id"),
                    F.coalesce("e.content._VALUE", "e.summary._VALUE", F.lit("")).alias("content"),
                    F.lit("").alias("author"), text_or(F.col("e.updated")).alias("published")))
    return rss.unionByName(atom).withColumn("published_ts", feed_epoch(F.col("published")))


def feed_documents(items: DataFrame, instance_id: str, since: float = 0.0,
                   seq: Column | None = None) -> DataFrame:
    """Items published after `since` -> plain-text documents.  Items without a
    readable date have epoch 0 and never pass."""
    col = F.col
    fallback = F.concat(col("feed_url"), F.lit("#"), F.substring(F.md5(F.to_json(F.struct(
        *[col(c) for c in ITEM_COLUMNS])).cast("binary")), 1, 8))
    uri = F.coalesce(F.nullif(col("link"), F.lit("")), F.nullif(col("id"), F.lit("")), fallback)
    rows = items.where(col("published_ts") > since).withColumn("_uri", uri)
    return envelope(
        rows, connector_id="rss", instance_id=F.lit(instance_id), uri=col("_uri"),
        content=col("content"), content_type="text/plain",
        seq=seq if seq is not None else F.monotonically_increasing_id(),
        cursor_value=col("published_ts"),
        metadata=meta(feed_url=col("feed_url"), title=col("title"), published=col("published"),
                      author=col("author")))
