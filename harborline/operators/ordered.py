"""Order-dependent operators that survive a hot group.

A window over a group puts the whole group into one task.  `running` cuts each
group into chunks along its order, folds every chunk to one small row, scans
those rows, and finishes inside the chunks: no task holds more than one chunk
of rows, whatever the group's share of the data is.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

CHUNK_ROWS = 100_000


def seq_chunk(order: str, rows: int = CHUNK_ROWS) -> Column:
    """Chunk of a unique, roughly dense sequence number."""
    return F.call_function("div", F.col(order), F.lit(rows))


def running(rows: DataFrame, group: list[str], order: str,
            values: dict[str, tuple[str, Column]], *, inclusive: bool = True,
            chunk: Column | None = None,
            inside: dict[str, Callable[[WindowSpec], Column]] | None = None) -> DataFrame:
    """Adds running values per `group` in `order`.

    `values` maps a new column to (kind, expression); kind is `sum`, `max` or
    `last` (last non-null).  With `inclusive=False` a row does not see itself.
    `order` must be unique within a group; a null group is a group.  `inside`
    adds columns over the ordered chunk alone, on the same partitioning.
    """
    fold = {
        "sum": lambda c: F.sum(c),
        "max": lambda c: F.max(c),
        "last": lambda c: F.max_by(c, F.when(c.isNotNull(), F.col(order))),
    }
    scan = {
        "sum": lambda c: F.sum(c), "max": lambda c: F.max(c),
        "last": lambda c: F.last(c, ignorenulls=True),
    }
    merge = {
        "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
        "max": lambda a, b: F.greatest(a, b),
        "last": lambda a, b: F.coalesce(b, a),
    }
    cut = rows.withColumn("_chunk", seq_chunk(order) if chunk is None else chunk)
    for name, (_, expr) in values.items():
        cut = cut.withColumn(f"_in_{name}", expr)
    keys = [*group, "_chunk"]
    totals = cut.groupBy(*keys).agg(
        *[fold[kind](F.col(f"_in_{n}")).alias(f"_t_{n}") for n, (kind, _) in values.items()])
    before = W.partitionBy(*group).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(*keys, *[
        scan[kind](F.col(f"_t_{n}")).over(before).alias(f"_c_{n}")
        for n, (kind, _) in values.items()])
    within = W.partitionBy(*keys).orderBy(order)
    frame = within.rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    done = cut.join(carry.withColumnsRenamed({k: f"_k_{k}" for k in keys}), same)
    for n, (kind, _) in values.items():
        done = done.withColumn(n, merge[kind](F.col(f"_c_{n}"),
                                              scan[kind](F.col(f"_in_{n}")).over(frame)))
    for n, column in (inside or {}).items():
        done = done.withColumn(n, column(within))
    drop = ["_chunk", *[f"_k_{k}" for k in keys]] + [f"_{p}_{n}" for n in values for p in ("in", "c")]
    return done.drop(*drop)


def previous(rows: DataFrame, group: list[str], order: str, value: Column, name: str,
             chunk: Column | None = None) -> DataFrame:
    """`lag(value)` as column `name`; null on a group's first row."""
    boxed = running(rows, group, order, {"_prev": ("last", F.struct(value.alias("v")))},
                    inclusive=False, chunk=chunk)
    return boxed.withColumn(name, F.col("_prev.v")).drop("_prev")


def limit_per_key(rows: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows per key.  The optimizer turns this into a per-task
    group limit before the shuffle, so a hot key ships n rows per task."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def limit_batch(rows: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows of a pull."""
    return rows.orderBy(*order).limit(n)


def union_resources(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """One stream from several resource types; `resource_rank` keeps their
    order, `resource_type` their name."""
    out = None
    for rank, (name, df) in enumerate(parts):
        part = df.withColumn("resource_rank", F.lit(rank)).withColumn("resource_type", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
