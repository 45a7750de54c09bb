"""De-duplication.

No operator here opens a window over a document key: one key may own a third
of all rows.  Winners are found with a map-side combined `min`, and their flag
travels back on the row's own unique `seq`, which spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fresh_winners(rows: DataFrame, keys: list[str], known: DataFrame | None = None,
                  order: str = "seq", valid: Column | None = None) -> DataFrame:
    """`order` of each key's first valid row, keys already stored left out.

    The stored keys are tested against the winners, one row per key, so the
    test cannot be skewed and reuses the aggregation's partitioning.
    """
    value = F.col(order) if valid is None else F.when(valid, F.col(order))
    first = (rows.groupBy(*keys).agg(F.min(value).alias(order))
             .where(F.col(order).isNotNull()))
    if known is not None:
        # Known keys are first reduced to those of this batch, which is the side that may be sent
        # to all tasks: a small batch doesn't shuffle all that was ever stored.
        met = known.select(*keys).join(first.select(*keys), keys, "left_semi")
        first = first.join(met, keys, "left_anti")
    return first.select(order)


def mark_first(rows: DataFrame, keys: list[str], order: str = "seq",
               valid: Column | None = None, known: DataFrame | None = None) -> DataFrame:
    """Adds `is_first`: true on the first valid row of each key that `known`
    lacks.  `order` must be unique in `rows`."""
    first = fresh_winners(rows, keys, known, order, valid).withColumn("_first", F.lit(True))
    return (rows.join(first, order, "left")
            .withColumn("is_first", F.coalesce("_first", F.lit(False))).drop("_first"))


def keep_first(rows: DataFrame, keys: list[str], order: str = "seq",
               valid: Column | None = None, known: DataFrame | None = None) -> DataFrame:
    return rows.join(fresh_winners(rows, keys, known, order, valid), order, "left_semi")


def drop_known(rows: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not stored yet.  The join strategy is left to the
    optimizer: the stored side grows, so it is never hinted."""
    return rows.join(known.select(key), key, "left_anti")


def two_tier(rows: DataFrame, known: DataFrame, key: str = "id", order: str = "seq",
             valid: Column | None = None) -> DataFrame:
    """First valid occurrence in the batch that the repository lacks."""
    return keep_first(rows, [key], order, valid, known)


def same_content(docs: DataFrame) -> DataFrame:
    """Documents with identical bytes: `is_first` marks the earliest acquired
    one; ties go to the smaller id, then to the earlier row."""
    rank = F.struct("acquired_at", "id", "seq")
    first = (docs.groupBy("checksum").agg(F.min(rank).alias("r"))
             .select(F.col("r.seq").alias("seq"), F.lit(True).alias("_first")))
    return (docs.join(first, "seq", "left")
            .withColumn("is_first", F.coalesce("_first", F.lit(False))).drop("_first"))
