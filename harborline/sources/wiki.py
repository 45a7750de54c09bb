"""Wiki pages, blog posts, spaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.functions.text import html_to_markdown, html_to_text
from harborline.operators.envelope import envelope
from harborline.operators.forest import ascend, lookup
from harborline.session import materialize
from harborline.sources.common import json_doc, meta, tag, text_or

CONTENT = ("id string, title string, type string, version struct<number:int,when:string>, "
           "space struct<key:string,name:string>, ancestors array<struct<title:string>>, "
           "_links struct<webui:string>, body struct<storage:struct<value:string>>")
# MIME type per output form.
FORMS = {"text": "text/plain", "markdown": "text/markdown", "storage": "text/html"}


def content_documents(rows: DataFrame, base_url: str, instance_id: str, form: str = "text",
                      seq: Column | None = None) -> DataFrame:
    """Landed content (`p` parsed) -> documents in one of FORMS; blank ones
    are left out."""
    p = F.col("p")
    html = text_or(p["body"]["storage"]["value"])
    title = text_or(p["title"], "Untitled")
    if form == "markdown":
        text = F.concat(F.lit("# "), title, F.lit("\n\n"), html_to_markdown(html))
    elif form == "text":
        text = F.concat(title, F.lit("\n\n"), html_to_text(html))
    else:
        text = html
    kind = text_or(p["type"], "page")
    number = F.coalesce(p["version"]["number"], F.lit(1))
    when = text_or(p["version"]["when"])
    url = F.concat(F.lit(base_url.rstrip("/")), text_or(p["_links"]["webui"]))
    space = text_or(p["space"]["key"])
    ready = rows.withColumn("_text", text).where(F.col("_text").rlike(r"\S"))
    return envelope(
        ready, connector_id="confluence", instance_id=F.lit(instance_id), uri=url,
        content=F.col("_text"), content_type=FORMS.get(form, "text/html"),
        seq=seq if seq is not None else F.monotonically_increasing_id(),
        version=number.cast("string"), cursor_value=when, tags=[kind, tag("space:", space)],
        metadata=meta(resource_type=kind, content_id=text_or(p["id"]), title=title,
                      space_key=space, version=number, last_modified=when,
                      ancestors=F.transform(F.coalesce(p["ancestors"], F.array().cast(
                          "array<struct<title:string>>")), lambda a: text_or(a["title"])),
                      web_url=url))


def space_documents(rows: DataFrame, base_url: str, instance_id: str,
                    seq: Column | None = None) -> DataFrame:
    """Spaces (key, name, description) -> JSON documents."""
    key, name = text_or(F.col("key")), text_or(F.col("name"))
    return envelope(
        rows, connector_id="confluence", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit(base_url.rstrip("/") + "/display/"), key),
        content=json_doc(key=key, name=name, description=text_or(F.col("description"))),
        content_type="application/json",
        seq=seq if seq is not None else F.monotonically_increasing_id(), tags=["space"],
        metadata=meta(resource_type=F.lit("space"), space_key=key, name=name))


def comment_paths(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """`comments` (comment_id, parent_id and more) with page_id, depth and
    `ancestors`, the comments above from the page down.  A parent is a page (id)
    or another comment, replies go to any depth.

    Comments that lead to no page are left out, those on a circle among them.
    Only comments that have replies take part in the walk, by pointer
    jumping; a page or comment that owns most comments is looked up without
    being one task's.  A repeated comment id holds its replies under its least parent.
    """
    comments = materialize(comments, "comments")
    named = pages.select(F.col("id").alias("page_id")).distinct()
    answered = comments.select(F.col("parent_id").alias("comment_id")).distinct()
    links = comments.where("parent_id is not null").select("comment_id", "parent_id") \
        .join(answered, "comment_id", "left_semi").groupBy(F.col("comment_id").alias("node")) \
        .agg(F.min("parent_id").alias("parent"))
    links = links.join(named.select(F.col("page_id").alias("node")), "node", "left_anti").withColumn("step", F.col("node"))
    inside = ascend(links, path=True).withColumnRenamed("root", "page_id").join(named, "page_id", "left_semi")
    above = named.select(F.col("page_id").alias("parent_id"), "page_id", F.lit(0).cast("long").alias("depth"),
                         F.array().cast("array<string>").alias("ancestors")).unionByName(
        inside.select(F.col("node").alias("parent_id"), "page_id", "depth", F.col("path").alias("ancestors")))
    return lookup(comments, materialize(above, "above"), "parent_id", "inner")


def comment_documents(placed: DataFrame, base_url: str, instance_id: str, seq: Column | None = None) -> DataFrame:
    """Rows of `comment_paths` with author, created and html -> one plain-text
    document each; blank ones are left out."""
    col = F.col
    ready = placed.withColumn("_text", html_to_text(text_or(col("html")))).where(col("_text").rlike(r"\S"))
    return envelope(
        ready, connector_id="confluence", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit(base_url.rstrip("/") + "/pages/"), col("page_id"), F.lit("#comment-"), col("comment_id")),
        content=col("_text"), content_type="text/plain",
        seq=seq if seq is not None else F.monotonically_increasing_id(), version=text_or(col("created")),
        cursor_value=text_or(col("created")), tags=["comment", tag("page:", col("page_id"))],
        metadata=meta(resource_type=F.lit("comment"), comment_id=col("comment_id"), page_id=col("page_id"),
                      parent_id=col("parent_id"), depth=col("depth"), ancestors=col("ancestors"),
                      author=text_or(col("author"))))
