"""Parent rows with nested children, and the other set-based lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from harborline.catalog import values as V
from harborline.functions.names import mime_major
from harborline.operators.ordered import limit_per_key
from harborline.session import materialize


def _text_bytes(item: Column, schema: T.StructType) -> Column:
    """Bytes of a struct's top-level strings: never more than its JSON."""
    lengths = [F.coalesce(F.octet_length(item[f.name]), F.lit(0)) for f in schema.fields
               if isinstance(f.dataType, T.StringType)]
    return reduce(lambda a, b: a + b, lengths, F.lit(0)).cast("bigint")


def nest(parents: DataFrame, children: DataFrame, keys: list[str], item: Column, order: list[str],
         name: str, max_bytes: int = V.MAX_DOCUMENT_BYTES, bounded: bool = False) -> DataFrame:
    """Parents left-joined with their ordered children as array `name`; adds
    `<name>_count` and `<name>_bytes` (a lower bound of the children's JSON).

    One parent may own any share of the children, but a document above
    `max_bytes` is rejected by validation anyway.  So children are measured
    first, with a map-side combined sum, and gathered only for parents that
    can still become a document; for the others `name` is null, and `withheld`
    carries their bytes into the document's size, so that validation rejects
    it.  Their children stay where they landed.  The children, stripped to what is nested, are written to the
    shared folder once, so that parsing them is not repeated; when no parent
    is too large, which one aggregate tells, the filter is left out.

    `bounded` says that the caller has already limited children per parent.
    """
    packed = children.select(*keys, F.struct(*[F.col(o).alias(f"_o{i}") for i, o
                                               in enumerate(order)], item.alias("v")).alias("_item"))
    weight = _text_bytes(F.col("_item.v"), packed.schema["_item"].dataType["v"].dataType)
    totals = [F.count("*").alias(f"{name}_count"), F.sum(weight).alias(f"{name}_bytes")]
    gather = F.sort_array(F.collect_list("_item")).alias("_items")
    unpack = F.transform("_items", lambda e: e["v"]).alias(name)
    shape = [*keys, f"{name}_count", f"{name}_bytes"]

    if not bounded:
        packed = materialize(packed, "children")
        measured = packed.groupBy(*keys).agg(*totals)
        large = measured.where(F.col(f"{name}_bytes") > max_bytes)
        bounded = large.isEmpty()
    if bounded:
        sized = packed.groupBy(*keys).agg(*totals, gather).select(*shape, unpack)
    else:
        small = packed.join(large.select(*keys), keys, "left_anti")
        sized = (small.groupBy(*keys).agg(*totals, gather).select(*shape, unpack)
                 .unionByName(large.select(*shape), allowMissingColumns=True))
    none = F.array().cast(dict(sized.dtypes)[name])
    return (parents.join(sized, keys, "left")
            .withColumn(f"{name}_count", F.coalesce(f"{name}_count", F.lit(0)))
            .withColumn(f"{name}_bytes", F.coalesce(f"{name}_bytes", F.lit(0)))
            .withColumn(name, F.when(F.col(f"{name}_count") == 0, none).otherwise(F.col(name))))


def withheld(*names: str) -> Column:
    """Bytes of children that `nest` left out of a row."""
    return reduce(lambda a, b: a + b, [F.when(F.col(n).isNull(), F.col(f"{n}_bytes")).otherwise(0) for n in names])


def thread_replies(messages: DataFrame, max_replies: int | None = None) -> DataFrame:
    """Thread parents with their replies in time order.

    All landed replies are kept.  `max_replies` keeps the first so many, as a
    remote listing would; it is a per-key limit, so an endless thread ships
    that many rows per task.
    """
    parent = messages.where((F.col("thread_ts") == F.col("ts")) & (F.col("reply_count") > 0))
    reply = messages.where(F.col("thread_ts").isNotNull() & (F.col("thread_ts") != F.col("ts")))
    kept = reply if max_replies is None else limit_per_key(
        reply, ["channel_id", "thread_ts"], ["ts"], max_replies)
    item = F.struct(F.coalesce("user", F.lit("")).alias("user"),
                    F.coalesce("text", F.lit("")).alias("text"), F.col("ts").alias("ts"))
    rows = kept.select("channel_id", "thread_ts", F.col("ts").alias("_ts"), item.alias("_v"))
    return nest(parent, rows, ["channel_id", "thread_ts"], F.col("_v"), ["_ts"], "replies",
                bounded=max_replies is not None)


def file_blobs(entries: DataFrame, blobs: DataFrame) -> DataFrame:
    """Tree entries with their content.  Blobs are content-addressed, so they
    are unique by sha; many paths may share one (a skewed, splittable side)."""
    return entries.join(blobs, "sha")


def primary_keys(constraints: DataFrame, key_columns: DataFrame) -> DataFrame:
    """Primary-key columns from landed catalog views."""
    keys = constraints.where(F.col("constraint_type") == "PRIMARY KEY").select(
        "constraint_name", "table_schema", "table_name")
    return (keys.join(key_columns.select("constraint_name", "column_name", "ordinal_position"),
                      "constraint_name"))


def table_sizes(tables: DataFrame, classes: DataFrame, schema: str) -> DataFrame:
    """Base tables with the catalog's row estimate and size."""
    return (tables.where((F.col("table_schema") == schema)
                         & (F.col("table_type") == "BASE TABLE"))
            .join(classes, F.col("relname") == F.col("table_name"))
            .select("table_name", "estimated_rows", "size_bytes"))


_WAYS = 64


def mime_routes(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Documents x connectors that accept their MIME type.

    The manifest (connector_id, mime) is first reduced to entries that cannot
    overlap -- `*/*` makes a connector's other entries moot, `major/*` its
    exact ones -- so an equi-join on three keys per document yields each pair
    once and no distinct is needed.  `*/*` would be one key for all documents,
    so it is spread over `_WAYS` by the task that reads a document.
    """
    flags = manifest.groupBy("connector_id").agg(F.collect_set("mime").alias("all"))
    lean = (flags.withColumn("mime", F.explode("all"))
            .where((F.col("mime") == "*/*")
                   | (~F.array_contains("all", F.lit("*/*"))
                      & (F.endswith("mime", F.lit("/*"))
                         | ~F.array_contains(F.col("all"), mime_major(F.col("mime"))))))
            .select("connector_id", "mime")
            .withColumn("_way", F.explode(F.when(F.col("mime") == "*/*", F.sequence(F.lit(0), F.lit(_WAYS - 1)))
                                          .otherwise(F.array(F.lit(0))))))
    keyed = docs.withColumn("mime", F.explode(F.array_distinct(F.array(
        F.col("content_type"), mime_major(F.col("content_type")), F.lit("*/*"))))) \
        .withColumn("_way", F.when(F.col("mime") == "*/*", F.spark_partition_id() % _WAYS).otherwise(0))
    return keyed.join(lean, ["mime", "_way"]).drop("mime", "_way")
