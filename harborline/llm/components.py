"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harborline.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); component is the
    smallest node reachable.

    Each round links larger neighbours to the smallest one, then smaller ones
    (Kiveris et al., 2014): every node ends up pointing at its minimum after
    about log(n) rounds, and no round makes more edges than it was given.
    Minima are combined map-side, so a node that owns most edges costs one row
    per task.  Each round is a table in the shared folder.  Rows with a null or
    a loop are ignored; no edges give no rows.
    """
    now = materialize(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
                              F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e"))
        now = materialize(small.select(F.col("e.x").alias("a"), F.col("e.y").alias("b"))
                          .where("a <> b").distinct(), "edges")
        mark = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                             F.sum(F.hash("a", "b").cast("long"))).first())
        if mark == before:
            break
        before = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b"), F.col("b")).distinct())
