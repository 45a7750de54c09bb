"""Database tables, their catalog, and change logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from harborline.functions.codec import lsn_order
from harborline.operators.envelope import envelope
from harborline.sources.common import KEEP_NULLS, iso, json_doc, meta, tag

# Column names taken for a key when none is declared.
KEY_CANDIDATES = ("id", "uuid", "pk", "key")


def read_jdbc(spark: SparkSession, url: str, table: str, *, split_on: str | None = None,
              bounds: tuple | None = None, partitions: int = 1, **options: str) -> DataFrame:
    """A remote table.  Predicates, columns and limits of later operators are
    pushed to the database; `split_on` reads it with parallel range scans."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, pushDownLimit="true",
                                               pushDownOffset="true", **options)
    if split_on and bounds:
        reader = reader.options(partitionColumn=split_on, lowerBound=str(bounds[0]),
                                upperBound=str(bounds[1]), numPartitions=str(partitions))
    return reader.load()


def snapshot(table: DataFrame, cursor_column: str | None, since=None,
             max_rows: int | None = None) -> DataFrame:
    """Rows after `since`; all rows when there is no position or no such column.

    `max_rows` bounds a pull, by default nothing does.  The bound is a position,
    not a number of rows: everything up to the position of the max_rows-th
    oldest row comes, ties included, so the next pull, which starts after that
    position, misses nothing.  Only positions are ranked, from counts per
    position; no rows are sorted or sent to one task.  Rows without a position
    come with a full read only, which a bound doesn't cut, nor does it cut a
    table without a cursor column: nothing could tell where to go on.
    """
    if cursor_column is None or cursor_column not in table.columns:
        return table
    position = F.col(cursor_column)
    rows = table if since is None else table.where(
        position > F.lit(since).cast(table.schema[cursor_column].dataType))
    if max_rows is None:
        return rows
    # The bounded number of oldest distinct positions holds the one we look for.
    oldest = (rows.where(position.isNotNull()).groupBy(position.alias("_p")).agg(F.count("*").alias("_n"))
              .orderBy("_p").limit(max_rows))
    upto = oldest.withColumn("_sum", F.sum("_n").over(W.orderBy("_p"))).agg(
        F.min(F.when(F.col("_sum") >= max_rows, F.col("_p"))).alias("_end"))
    end = upto.scalar()
    return rows.where(position.isNull() | end.isNull() | (position <= end))


def _format(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        return iso(c, "+00:00" if isinstance(f.dataType, T.TimestampType) else "")
    if isinstance(f.dataType, T.BinaryType):
        return F.when(c.isNotNull(), "<binary>")
    if isinstance(f.dataType, T.DecimalType):
        return c.cast("double")
    return c


def serializable(df: DataFrame) -> DataFrame:
    """JSON-ready columns: timestamps as ISO text, binary as a marker,
    decimals as doubles.  Decided once, on the schema."""
    return df.select(*[_format(f).alias(f.name) for f in df.schema.fields])


def _as_text(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = iso(c, "+00:00" if isinstance(kind, T.TimestampType) else "")
    return F.coalesce(c.cast("string"), F.lit("None"))


def row_pk(df: DataFrame, primary_keys=()) -> Column:
    """Declared keys joined by `|`, else a column that looks like a key, else
    a stable digest of all columns.  Each value is given with its length, so
    that no two rows read alike."""
    if primary_keys:
        return F.concat_ws("|", *[_as_text(df, k) if k in df.columns else F.lit("")
                                  for k in primary_keys])
    for name in KEY_CANDIDATES:
        if name in df.columns:
            return _as_text(df, name)
    parts = [_as_text(df, n) for n in df.columns]
    return F.sha2(F.concat_ws("|", *[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]), 256)


def row_documents(table: DataFrame, name: str, instance_id: str, *, schema: str = "public",
                  primary_keys=(), cursor_column: str = "updated_at",
                  seq: Column | None = None) -> DataFrame:
    """Rows -> JSON documents; a narrow projection."""
    pk = row_pk(table, primary_keys)
    version = (F.when(F.col(cursor_column).isNotNull(), _as_text(table, cursor_column))
               if cursor_column in table.columns else F.lit(None).cast("string"))
    payload = F.struct(*[_format(f).alias(f.name) for f in table.schema.fields])
    rows = table.select(pk.alias("_pk"), version.alias("_version"),
                        (seq if seq is not None else F.monotonically_increasing_id()).alias("_seq"),
                        F.to_json(payload, KEEP_NULLS).alias("_content"))
    col = F.col
    return envelope(
        rows, connector_id="postgresql", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit(f"postgresql://{schema}/{name}/"), col("_pk")), content=col("_content"),
        content_type="application/json", seq=col("_seq"), version=col("_version"),
        cursor_value=col("_version"), tags=["row", f"table:{name}", f"schema:{schema}"],
        metadata=meta(resource_type=F.lit("table_row"), schema=F.lit(schema), table=F.lit(name),
                      pk=col("_pk"), columns=F.array(*[F.lit(c) for c in table.columns])))


def inventory(tables: dict[str, DataFrame], sizes: bool = False) -> DataFrame:
    """Row count per table and, on request, bytes on disk.  A bare count is
    answered from file footers and sizes from the listing: no data is read."""
    def one(name: str, df: DataFrame) -> DataFrame:
        rows = df.agg(F.count("*").alias("estimated_rows")).select(
            F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("columns"),
            "estimated_rows")
        if not sizes:
            return rows
        listed = df.sparkSession.read.format("binaryFile").load(df.inputFiles())
        size = listed.agg(F.sum("length").alias("size_bytes")).withColumn("table_name", F.lit(name))
        return rows.join(size, "table_name")

    return reduce(DataFrame.unionByName, [one(n, df) for n, df in tables.items()])


def columns_of(spark: SparkSession, tables: dict[str, DataFrame],
               primary_keys: dict[str, list[str]] | None = None) -> DataFrame:
    """Schema rows: column, type, nullability, position in the key (or null)."""
    keys = primary_keys or {}
    rows = [(name, f.name, f.dataType.simpleString(), f.nullable, i + 1,
             keys.get(name, []).index(f.name) + 1 if f.name in keys.get(name, []) else None)
            for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, "
                                       "nullable boolean, ordinal int, key_position int")


def cdc_documents(changes: DataFrame, instance_id: str, seq: Column | None = None) -> DataFrame:
    """Change-log rows (lsn, data) -> documents; works on a stream as it is.

    Data is JSON when it starts with `{` and parses, else it is kept raw.
    """
    lsn, data = F.col("lsn").cast("string"), F.col("data")
    looks_json = F.startswith(data, F.lit("{"))
    tree = F.when(looks_json, F.try_parse_json(data))
    is_json = tree.isNotNull()
    raw = F.when(looks_json, json_doc(raw=data, lsn=lsn)).otherwise(json_doc(raw=data))
    field = lambda name: F.when(is_json, F.coalesce(
        F.get_json_object(data, f"$.{name}"), F.lit("unknown"))).otherwise("unknown")
    rows = changes.withColumn("_action", field("action")).withColumn("_table", field("table"))
    # The change is spliced in as JSON, not as a quoted string.
    content = F.concat(F.lit('{"lsn":"'), lsn, F.lit('","change":'),
                       F.when(is_json, data).otherwise(raw), F.lit("}"))
    col = F.col
    return envelope(
        rows, connector_id="postgresql", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit("postgresql://cdc/"), col("_table"), F.lit("/"), lsn),
        content=content, content_type="application/json",
        seq=seq if seq is not None else lsn_order(lsn), version=lsn, cursor_value=lsn,
        cursor_type="sequence",
        tags=["cdc", tag("table:", col("_table")), tag("action:", col("_action"))],
        metadata=meta(resource_type=F.lit("cdc_change"), table=col("_table"),
                      action=col("_action"), lsn=lsn))
