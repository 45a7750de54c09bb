"""Note pages, their block trees, databases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.functions.text import rich_text
from harborline.operators.envelope import envelope
from harborline.operators.filters import note_wanted
from harborline.operators.forest import ascend, lookup
from harborline.operators.joins import nest, withheld
from harborline.session import materialize
from harborline.sources.common import json_doc, meta, tag, text_or

_RUNS = "array<struct<plain_text:string>>"
PAGE = ("id string, url string, created_time string, last_edited_time string, archived boolean, "
        "created_by struct<id:string>, last_edited_by struct<id:string>, "
        "parent struct<type:string,page_id:string,database_id:string,block_id:string>, "
        "icon struct<type:string,emoji:string,external:struct<url:string>>, "
        f"properties map<string,struct<type:string,title:{_RUNS}>>")


def title_of(properties: Column) -> Column:
    """Text of the first of title / Name / Title that is title-typed."""
    found = [F.when(F.try_element_at(properties, F.lit(k))["type"] == "title",
                    rich_text(F.try_element_at(properties, F.lit(k))["title"]))
             for k in ("title", "Name", "Title")]
    return F.coalesce(*found, F.lit("Untitled"))


def icon_of(icon: Column) -> Column:
    return (F.when(icon["type"] == "emoji", icon["emoji"])
            .when(icon["type"] == "external", icon["external"]["url"]))


def block_paths(pages: DataFrame, blocks: DataFrame,
                max_depth: int | None = None) -> DataFrame:
    """Blocks (block_id, parent_id, ordinal, type, text, has_children) placed
    in their page's tree: page_id, depth and the ordinal path that sorts them
    in reading order, down to the deepest level or to `max_depth`.

    Pages and paths are found by pointer jumping over the thin (block, parent,
    ordinal) of blocks that have children; the text is joined once, in the end.
    Blocks that lead to no page, as those on a cycle, are left out.  A block id
    that is repeated holds its children where it stands first, by parent and
    ordinal; a page is a root wherever it is mentioned.
    """
    inner = blocks.where("has_children and parent_id is not null").groupBy("block_id").agg(
        F.min(F.struct("parent_id", F.col("ordinal").cast("int").alias("ordinal"))).alias("at"))
    links = inner.select(F.col("block_id").alias("node"), F.col("at.parent_id").alias("parent"),
                         F.col("at.ordinal").alias("step")).join(pages.select(F.col("id").alias("node")), "node", "left_anti")
    named = pages.select(F.col("id").alias("page_id")).distinct()
    inside = ascend(links, path=True).withColumnRenamed("root", "page_id").join(named, "page_id", "left_semi")
    above = named.select(F.col("page_id").alias("parent_id"), "page_id", F.lit(0).cast("long").alias("depth"),
                         F.array().cast("array<int>").alias("_path")).unionByName(
        inside.select(F.col("node").alias("parent_id"), "page_id", "depth", F.col("path").alias("_path")))
    placed = lookup(blocks, materialize(above, "above"), "parent_id", "inner")
    placed = placed.withColumn("path", F.concat("_path", F.array(F.col("ordinal").cast("int")))) \
        .withColumn("depth", F.col("depth").cast("int")).drop("_path")
    return placed if max_depth is None else placed.where(F.col("depth") <= max_depth)


def block_line(kind: Column, text: Column, depth: Column) -> Column:
    """Markdown of one block; list-like blocks are indented by depth."""
    pad = F.repeat(F.lit("  "), depth)
    return (F.when(kind == "heading_1", F.concat(F.lit("# "), text))
            .when(kind == "heading_2", F.concat(F.lit("## "), text))
            .when(kind == "heading_3", F.concat(F.lit("### "), text))
            .when(kind == "bulleted_list_item", F.concat(pad, F.lit("- "), text))
            .when(kind == "numbered_list_item", F.concat(pad, F.lit("1. "), text))
            .when(kind == "to_do", F.concat(pad, F.lit("- [ ] "), text))
            .when(kind == "toggle", F.concat(pad, F.lit("> "), text))
            .when(kind == "code", F.concat(F.lit("```\n"), text, F.lit("\n```")))
            .when(kind == "quote", F.concat(F.lit("> "), text))
            .when(kind == "divider", F.lit("---"))
            .otherwise(text))


def pages_markdown(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """(page id, markdown): lines in reading order, blank ones dropped."""
    placed = block_paths(pages, blocks)
    lines = (placed.withColumn("line", block_line(F.col("type"), text_or(F.col("text")),
                                                  F.col("depth")))
             .where(F.length("line") > 0)
             .select(F.col("page_id").alias("id"), "path", "line"))
    nested = nest(pages.select("id"), lines, ["id"], F.struct("line"), ["path"], "lines")
    return nested.select("id", F.array_join(F.transform("lines", lambda l: l["line"]), "\n\n")
                         .alias("markdown"), "lines_bytes")


def page_documents(pages: DataFrame, markdown: DataFrame, instance_id: str,
                   since: str | None = None, seq: Column | None = None) -> DataFrame:
    """Pages (`p` parsed) with their markdown; pages without text fall back
    to a JSON form."""
    p = F.col("p")
    kept = pages.where(note_wanted(p["archived"], p["last_edited_time"], since))
    rows = (kept.withColumn("id", p["id"]).join(markdown, "id", "left")
            .withColumn("_title", title_of(p["properties"])))
    fallback = json_doc(title=F.col("_title"), properties=p["properties"])
    parent = text_or(p["parent"]["type"], "workspace")
    parent_id = (F.when(parent == "page_id", p["parent"]["page_id"])
                 .when(parent == "database_id", p["parent"]["database_id"])
                 .when(parent == "block_id", p["parent"]["block_id"]))
    edited = text_or(p["last_edited_time"])
    return envelope(
        rows, connector_id="notion", instance_id=F.lit(instance_id), uri=text_or(p["url"]),
        content=F.coalesce(F.nullif("markdown", F.lit("")), fallback),
        content_type="text/markdown",
        withheld=F.when(F.col("markdown").isNull(), F.col("lines_bytes")),
        seq=seq if seq is not None else F.monotonically_increasing_id(), version=edited,
        cursor_value=edited, tags=["page", tag("parent:", parent)],
        metadata=meta(resource_type=F.lit("page"), notion_id=p["id"], title=F.col("_title"),
                      parent_type=parent, parent_id=parent_id,
                      created_time=text_or(p["created_time"]), last_edited_time=edited,
                      archived=F.coalesce(p["archived"], F.lit(False)), icon=icon_of(p["icon"])))


def database_rows(databases: DataFrame, rows: DataFrame) -> DataFrame:
    """Databases with their rows, oldest edit first, counted and collected."""
    item = F.struct(F.col("id").alias("id"), F.col("title").alias("title"),
                    F.col("last_edited").alias("last_edited"))
    packed = rows.select("db_id", F.col("last_edited").alias("_at"), F.col("id").alias("_id"),
                         item.alias("_v"))
    return nest(databases, packed, ["db_id"], F.col("_v"), ["_at", "_id"], "rows")


def database_documents(databases: DataFrame, rows: DataFrame, instance_id: str,
                       seq: Column | None = None) -> DataFrame:
    """Databases (db_id, url, title, schema, last_edited_time) + rows -> one
    JSON document each."""
    full = database_rows(databases, rows)
    col = F.col
    title = F.coalesce(F.nullif("title", F.lit("")), F.lit("Untitled DB"))
    return envelope(
        full, connector_id="notion", instance_id=F.lit(instance_id), uri=col("url"),
        withheld=withheld("rows"),
        content=json_doc(id=col("db_id"), title=title, schema=col("schema"),
                         row_count=col("rows_count"), rows=col("rows")),
        content_type="application/json",
        seq=seq if seq is not None else F.monotonically_increasing_id(),
        version=col("last_edited_time"), cursor_value=col("last_edited_time"), tags=["database"],
        metadata=meta(resource_type=F.lit("database"), notion_id=col("db_id"), title=title,
                      last_edited_time=col("last_edited_time")))
