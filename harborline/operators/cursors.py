"""Positions: delta predicates, composite positions, their running form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from harborline.catalog import values as V
from harborline.operators.ordered import seq_chunk


def delta(position: Column, since: Column | str | None, source: str | None = None,
          op: str = ">", kind: str = "text") -> Column:
    """Predicate "after `since`"; everything passes without a position.

    `source` picks strictness and type from the rule table.  A literal `since`
    reaches the Parquet or JDBC scan as a pushed filter.
    """
    if source is not None:
        op, kind = V.DELTA_RULES[source]
    if since is None:
        return F.lit(True)
    cast = {"text": "string", "double": "double", "bigint": "bigint"}[kind]
    if isinstance(since, Column):
        bound = since.try_cast(cast)
        left = position if kind == "text" else position.try_cast(cast)
        hit = left > bound if op == ">" else left >= bound
        return bound.isNull() | hit
    left = position if kind == "text" else position.cast(cast)
    return left > F.lit(since) if op == ">" else left >= F.lit(since)


def parse_composite(value: Column) -> Column:
    """Composite position JSON -> map; unreadable text gives an empty map."""
    return F.coalesce(F.from_json(F.when(value.rlike(r"^\s*\{"), value), "map<string,string>"),
                      F.create_map().cast("map<string,string>"))


def make_composite(positions: Column) -> Column:
    """Map -> JSON object with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(positions))))


def stamp_running(rows: DataFrame, group: str = "instance_id", key: str = "cursor_key",
                  position: str = "position", order: str = "seq",
                  chunk_rows: int = 1000) -> DataFrame:
    """Adds `composite`: the instance's composite position as of each row.

    Instances are cut into chunks of `chunk_rows`.  A chunk contributes the
    last position of each of its keys; a key's entry stays current until the
    next chunk that has it, which yields every chunk's carry-in map.  Inside a
    chunk only ends of same-key runs are collected, so rows arriving resource
    by resource add one entry per resource.
    """
    entry = F.struct(F.col(key).alias("key"), F.col(position).cast("string").alias("value"))
    cut = rows.withColumn("_chunk", seq_chunk(order, chunk_rows))
    parts = [group, "_chunk"]

    numbered = (cut.select(*parts).distinct()
                .withColumn("_no", F.row_number().over(W.partitionBy(group).orderBy("_chunk")))
                .withColumn("_last", F.max("_no").over(W.partitionBy(group))))
    ends = (cut.where(F.col(position).isNotNull()).groupBy(*parts, key)
            .agg(F.max_by(entry, order).alias("_e")).join(numbered, parts))
    until = F.coalesce(F.lead("_no").over(W.partitionBy(group, key).orderBy("_no")), F.col("_last"))
    carry = (ends.withColumn("_until", until).where("_no < _until")
             .withColumn("_no", F.explode(F.sequence(F.col("_no") + 1, F.col("_until"))))
             .groupBy(group, "_no").agg(F.collect_list("_e").alias("_carry"))
             .join(numbered.select(*parts, "_no"), [group, "_no"]).select(*parts, "_carry"))

    w = W.partitionBy(*parts).orderBy(order)
    run_end = (~F.col(key).eqNullSafe(F.lead(key).over(w))
               | F.lead(position).over(w).isNull())
    closed = (cut.withColumn("_end", F.when(run_end & F.col(position).isNotNull(), entry))
              .withColumn("_closed", F.collect_list("_end").over(
                  w.rowsBetween(W.unboundedPreceding, -1))))
    own = F.when(F.col(position).isNotNull(), F.array(entry)).otherwise(F.array().cast(
        "array<struct<key:string,value:string>>"))
    none = F.array().cast("array<struct<key:string,value:string>>")
    entries = F.concat(F.coalesce("_carry", none), "_closed", own)
    return (closed.join(carry, parts, "left")
            .withColumn("composite", make_composite(F.map_from_entries(entries)))
            .drop("_chunk", "_end", "_closed", "_carry"))


def advance_done(routed: DataFrame) -> DataFrame:
    """Instance position = cursor of its last document that was stored."""
    return (routed.where((F.col("status") == "done") & F.col("cursor").isNotNull())
            .groupBy("connector_id", "instance_id")
            .agg(F.max_by("cursor", "seq").alias("cursor"))
            .select("connector_id", "instance_id", F.col("cursor.value").alias("value"),
                    F.col("cursor.source_type").alias("source_type")))


def session_position(jobs: DataFrame) -> DataFrame:
    """Session position = greatest final position (as text) of completed jobs."""
    return (jobs.where((F.col("status") == "COMPLETED")
                       & (F.length("final_cursor_value") > 0))
            .groupBy("session_id").agg(F.max("final_cursor_value").alias("last_cursor")))


def lookup(rows: DataFrame, cursors: DataFrame, key: Column, position: str,
           op: str = ">") -> DataFrame:
    """Rows after their resource's stored position; unknown resources pass.

    One row per resource is stored, so the optimizer may broadcast it while
    small and falls back to a shuffle join when it is not.
    """
    stored = cursors.select(F.col("instance_id"), F.col("cursor_key"), F.col("value").alias("since"))
    joined = (rows.withColumn("cursor_key", key)
              .join(stored, ["instance_id", "cursor_key"], "left"))
    return joined.where(F.col("since").isNull()
                        | (F.col(position) > F.col("since") if op == ">"
                           else F.col(position) >= F.col("since")))


def unchanged_snapshots(rows: DataFrame, stored: DataFrame, keys=("repo", "tree_sha")) -> DataFrame:
    """Resources whose stored snapshot mark equals the current one are left out."""
    return rows.join(stored.select(*keys), list(keys), "left_anti")
