"""Parent pointers: roots, depths, paths and orders of forests of any depth.

Everything goes by pointer jumping: a node that knows the way to some ancestor
takes over what that ancestor knows, so the known way doubles each round and a
chain of a million nodes needs twenty rounds, not a million.  Rounds are tables in
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harborline.session import materialize

#: Keys that hold more than one in so many rows, of which there are no more than
#: that, are looked up by a broadcast; tables below `FEW` rows aren't examined.
HOT, FEW = 200, 100_000


def lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "left", size: int | None = None) -> DataFrame:
    """`rows` joined with the one row of `table` that has their `key`.

    A key may own any share of `rows`: the few keys above one in `HOT` rows
    are matched in place, the others by a shuffle.  Null keys match nothing and
    aren't shuffled.  `size`: the number of rows, if it is known.
    """
    if (rows.count() if size is None else size) <= FEW:
        return rows.join(table, key, how)
    given = rows.where(F.col(key).isNotNull())
    least = given.count() / HOT
    hot = materialize(given.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > least).select(key), "hot")
    cold = given.join(F.broadcast(hot), key, "left_anti").join(table, key, how)
    out = cold if hot.isEmpty() else cold.unionByName(
        given.join(F.broadcast(hot), key, "left_semi").join(
            F.broadcast(table.join(F.broadcast(hot), key, "left_semi")), key, how))
    if how == "inner":
        return out
    return out.unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)


def _jump(links: DataFrame, path: bool) -> tuple[DataFrame, DataFrame | None]:
    """(node, root, depth[, path]) of nodes that reach a root, and of those on or
    behind a cycle, if there are any, a node of that cycle (at) and the least
    node on the way (low).

    Where a node is left at depth d, another one is at each depth up to d.  So a
    round in which none reaches a root leaves only nodes that never will.
    They go on, without paths, until they have gone as many steps as there are of them.
    """
    more = ["path"] if path else []
    table = materialize(links.select(
        "node", F.col("parent").alias("at"), F.lit(1).cast("long").alias("depth"), F.col("node").alias("low"),
        *([F.array("step").alias("path")] if path else []), F.lit(False).alias("done")), "jump")
    done, size, steps, stalled = None, table.count(), 1, False
    while size:
        carried = ["at", "depth", "low", *([] if stalled else more)]
        ahead = table.select(F.col("node").alias("at"), *[F.col(c).alias(f"_{c}") for c in carried], F.col("done").alias("_done"))
        step = lookup(table.where("not done").select("node", *carried), ahead, "at", size=size).select(
            "node", F.coalesce("_at", "at").alias("at"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            F.least("low", "_low").alias("low"),
            *([F.coalesce(F.concat("_path", "path"), "path").alias("path")] if len(carried) > 3 else []),
            F.coalesce("_done", F.lit(True)).alias("done"))
        if stalled:
            table = materialize(step, "jump")
        else:
            table = materialize(table.where("done").unionByName(step), "jump")
            done = table.where("done").select("node", F.col("at").alias("root"), "depth", *more)
        before, size, steps = size, table.where("not done").count(), 2 * steps
        stalled = stalled or size == before
        if stalled and size:
            table = table.where("not done")
            if steps >= size:
                return done, table.select("node", "at", "low")
    return (done if done is not None else table.select("node", F.col("at").alias("root"), "depth", *more)), None


def ascend(links: DataFrame, path: bool = False) -> DataFrame:
    """(node, root, depth) for every row of `links` (node, parent), and with
    `path` the `step` values from the root down to the node.

    `node` is unique and `parent` not null; a parent that is no node itself is
    a root, known or not.  The nodes of a cycle have no root: the smallest of
    them becomes one, which cuts the cycle, and is itself left out.
    """
    links = materialize(links, "links")
    done, left = _jump(links, path)
    if left is not None:
        # that far up every way runs round its cycle, so where it stands is on it
        ring = left.select(F.col("at").alias("node")).distinct()
        cut = left.where("node = low").select("node").join(ring, "node", "left_semi")
        loose = links.join(left.select("node"), "node", "left_semi").join(cut, "node", "left_anti")
        done = done.unionByName(_jump(loose, path)[0])
    return done


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """`rows` with their place, from 0, in a global order; no task holds more
    than a range of it.  `order` should have few equal rows: those share a task.
    What goes to all tasks is one row per range."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = materialize(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                      .withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()), "ranges")
    sizes = cut.groupBy("_p").agg(F.count("*").alias("n"), F.min("_i").alias("first")).orderBy("_p").collect()
    offsets, at = [], 0
    for r in sizes:
        offsets.append((r._p, at - r.first))
        at += r.n
    shift = spark.createDataFrame(offsets, "_p int, _s long")
    return cut.join(F.broadcast(shift), "_p").withColumn(name, F.col("_i") + F.col("_s")).drop("_p", "_i", "_s")


def preorder(tree: DataFrame, order: list[str]) -> DataFrame:
    """`tree` (node, parent, further columns) with `place`, from 0, in the
    depth-first order of the forest; siblings, and roots among themselves, go by
    `order`.

    `node` is unique, a null parent makes a root, and there are no cycles (see
    `ascend`).  An Euler tour goes down into and up out of every node; it is a
    list whose elements know the next one.  Doubling these pointers counts, for
    each element, the ways down that are still to come.  Every element is the
    next of one other, so no join has a hot key.  The number of rounds is the
    logarithm of twice the number of nodes.
    """
    rows = materialize(numbered(tree, [F.col("parent").asc_nulls_first(), *order, "node"], "_n"), "tree")
    total = rows.count()
    above = rows.select(F.col("node").alias("parent"), F.col("_n").alias("_up"))
    first = rows.where("parent is not null").groupBy("parent").agg(F.min("_n").alias("_child")) \
        .withColumnRenamed("parent", "node")
    # the next sibling is the next row, if it has the same parent
    behind = rows.select((F.col("_n") - 1).alias("_n"), F.col("parent").alias("_other"), F.lit(True).alias("_any"))
    linked = lookup(rows.select("node", "parent", "_n"), above, "parent").join(first, "node", "left").join(behind, "_n", "left")
    sibling = F.coalesce(F.col("_any"), F.lit(False)) & F.col("_other").eqNullSafe(F.col("parent"))
    tour = linked.select(F.explode(F.array(
        F.struct((2 * F.col("_n")).alias("e"), F.coalesce(2 * F.col("_child"), 2 * F.col("_n") + 1).alias("next"),
                 F.lit(1).cast("long").alias("v")),
        F.struct((2 * F.col("_n") + 1).alias("e"), F.when(sibling, 2 * F.col("_n") + 2).otherwise(2 * F.col("_up") + 1).alias("next"),
                 F.lit(0).cast("long").alias("v")))).alias("x")).select("x.*")
    tour = materialize(tour, "tour")
    for _ in range((2 * total).bit_length()):
        ahead = tour.select(F.col("e").alias("next"), F.col("next").alias("_next"), F.col("v").alias("_v"))
        going = tour.where("next is not null").join(ahead, "next").select(
            "e", F.col("_next").alias("next"), (F.col("v") + F.col("_v")).alias("v"))
        tour = materialize(tour.where("next is null").unionByName(going), "tour")
    places = tour.where("e % 2 = 0").select(F.expr("e div 2").alias("_n"), (F.lit(total) - F.col("v")).alias("place"))
    return rows.join(places, "_n").drop("_n")
