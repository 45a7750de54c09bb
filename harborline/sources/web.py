"""Fetched web pages and generic API answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.functions.codec import json_path
from harborline.operators.envelope import envelope
from harborline.operators.ordered import limit_per_key
from harborline.sources.common import meta, tag


def web_documents(pages: DataFrame, instance_id: str, seq: Column | None = None) -> DataFrame:
    """Pages (url, content, content_type, etag, depth) -> documents; pages
    that answered without content are left out."""
    col = F.col
    rows = pages.where(F.octet_length("content") > 0)
    return envelope(
        rows, connector_id="web", instance_id=F.lit(instance_id), uri=col("url"),
        content=col("content"), content_type=col("content_type"),
        seq=seq if seq is not None else F.monotonically_increasing_id(),
        version=col("etag"), cursor_value=col("url"), cursor_type="token",
        tags=["webpage", tag("depth:", col("depth"))],
        metadata=meta(resource_type=F.lit("webpage"), url=col("url"), depth=col("depth"),
                      etag=col("etag")))


def api_items(answers: DataFrame, items_path: str = "", per_endpoint: int | None = None,
              order: list[str] = ("page_no",)) -> DataFrame:
    """Answer pages (endpoint, page_no, body, ...) -> one row per item.

    A list yields its elements, an object is a one-item list, anything else
    (or a missing path) yields nothing.
    """
    at = json_path(F.col("body"), items_path)
    listed = F.from_json(F.when(F.ltrim(at).startswith("["), at), "array<string>")
    single = F.when(F.ltrim(at).startswith("{"), F.array(at))
    rows = (answers.withColumn("_items", F.coalesce(listed, single))
            .select(*[c for c in answers.columns if c != "body"],
                    F.posexplode("_items").alias("item_no", "item")))
    if per_endpoint:
        rows = limit_per_key(rows, ["endpoint"], [*order, "item_no"], per_endpoint)
    return rows


def api_documents(items: DataFrame, base_url: str, instance_id: str,
                  seq: Column | None = None) -> DataFrame:
    """Items -> documents at `url/item_id`.  Items without id or uuid get a
    digest of their content."""
    item = F.col("item")
    item_id = F.coalesce(F.get_json_object(item, "$.id"), F.get_json_object(item, "$.uuid"),
                         F.sha2(item, 256))
    path = F.regexp_replace("endpoint", "^/+", "")
    rows = items.withColumn("_id", item_id)
    col = F.col
    return envelope(
        rows, connector_id="web", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit(base_url.rstrip("/") + "/"), path, F.lit("/"), col("_id")),
        content=item, content_type="application/json",
        seq=seq if seq is not None else F.monotonically_increasing_id(),
        tags=["api_item", tag("endpoint:", col("endpoint"))],
        metadata=meta(resource_type=F.lit("api_item"), endpoint=col("endpoint"),
                      item_id=col("_id")))
