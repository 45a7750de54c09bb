"""Object stores and file drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harborline.catalog import values as V
from harborline.functions.names import mime_by_object_key
from harborline.operators.cursors import delta
from harborline.operators.envelope import envelope
from harborline.operators.filters import by_extension, by_size
from harborline.operators.forest import numbered
from harborline.operators.ordered import limit_batch, running
from harborline.sources.common import iso, meta


def read_objects(spark: SparkSession, path: str, glob: str | None = None,
                 modified_after: str | None = None) -> DataFrame:
    """Listing with content, as the binary file source gives it.  Name and age
    are pruned while listing, before any byte is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path)


def listing(objects: DataFrame, root: str) -> DataFrame:
    """Binary-file rows -> (key, size, last_modified, etag, content)."""
    key = F.expr(f"substring(path, instr(path, '{root}') + {len(root)})")
    return objects.select(
        F.regexp_replace(key, "^/+", "").alias("key"), F.col("length").alias("size"),
        iso(F.col("modificationTime"), "+00:00").alias("last_modified"),
        F.md5("content").alias("etag"), "content")


def object_scan(objects: DataFrame, bucket: str, instance_id: str, *, prefix: str = "",
                max_bytes: int = V.MAX_OBJECT_BYTES, allow=(), since: str | None = None,
                limit: int | None = None, seq: Column | None = None) -> DataFrame:
    """Objects (key, size, last_modified, etag, content) -> documents.  Filters
    come first and touch only listing columns."""
    kept = objects.where(
        F.startswith("key", F.lit(prefix)) & by_size(F.col("size"), max_bytes)
        & by_extension(F.col("key"), V.OBJECT_EXCLUDED_EXTENSIONS, allow)
        & delta(F.col("last_modified"), since, "s3"))
    if limit:
        kept = limit_batch(kept, ["key"], limit)
    col = F.col
    return envelope(
        kept, connector_id="s3", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit(f"s3://{bucket}/"), col("key")), content=col("content"),
        content_type=mime_by_object_key(col("key")),
        seq=seq if seq is not None else F.monotonically_increasing_id(), version=col("etag"),
        cursor_value=col("last_modified"), tags=["s3", f"bucket:{bucket}"],
        metadata=meta(bucket=F.lit(bucket), key=col("key"), size=col("size"), etag=col("etag"),
                      last_modified=col("last_modified"), prefix=F.lit(prefix)))


def object_prefixes(objects: DataFrame, bucket: str, prefix: str = "") -> DataFrame:
    """First-level "folders" below a prefix, with how many objects they hold."""
    rest = F.expr(f"substring(key, {len(prefix) + 1})")
    return (objects.where(F.startswith("key", F.lit(prefix)) & F.contains(rest, F.lit("/")))
            .groupBy(F.concat(F.lit(f"s3://{bucket}/{prefix}"),
                              F.substring_index(rest, "/", 1), F.lit("/")).alias("resource"))
            .agg(F.count("*").alias("objects")))


def version_chains(versions: DataFrame) -> DataFrame:
    """Object versions (key, at, seq, deleted and more) with the time each is
    in force: from `at` to `until`, exclusive; the last one has no end and is
    `latest`.  Of versions of one instant the one with the greatest `seq` counts, the
    others are in force for no time.  A delete marker (`deleted`) is a version, too.

    The next version is the next row of a global order, so a key that owns most
    versions is spread over all tasks.
    """
    rows = numbered(versions, ["key", "at", "seq"], "_n")
    behind = rows.select((F.col("_n") - 1).alias("_n"), F.col("key").alias("_key"), F.col("at").alias("_at"))
    same = F.col("key").eqNullSafe(F.col("_key")) & F.col("_at").isNotNull()
    return rows.join(behind, "_n", "left").select(
        *versions.columns, F.when(same, F.col("_at")).alias("until"), (~F.coalesce(same, F.lit(False))).alias("latest"))


def versions_as_of(asked: DataFrame, versions: DataFrame, bucket_s: int = 86_400) -> DataFrame:
    """Each row of `asked` (key, at and more) with `found`, the version in force
    then (a struct of the columns of `versions` but key), or null: before the
    first one, and while the object was deleted.

    A key's versions and questions are dealt to buckets of time.  A bucket passes on
    one row, the last version in it; those are scanned, and the rest is decided inside
    the buckets, so no task holds more of a key than one bucket of it.
    """
    fields = [F.col(c) for c in versions.columns if c != "key"]
    known = versions.select("key", "at", F.lit(0).alias("_kind"), F.col("seq").cast("long").alias("_seq"),
                            F.struct(*fields).alias("_v"))
    asked = asked.withColumn("_ask", F.struct(*asked.columns))
    ask = asked.select("key", "at", F.lit(1).alias("_kind"), F.monotonically_increasing_id().alias("_seq"), "_ask")
    # a question sees what is in force from its own instant on
    both = known.unionByName(ask, allowMissingColumns=True) \
        .withColumn("_order", F.struct(F.unix_micros("at").alias("t"), "_kind", "_seq"))
    done = running(both, ["key"], "_order", {"found": ("last", F.col("_v"))},
                   chunk=F.floor(F.unix_micros("at") / (bucket_s * 1_000_000)))
    found = F.when(~F.col("found.deleted"), F.col("found"))
    return done.where("_kind = 1").select("_ask.*", found.alias("found"))


def version_documents(chains: DataFrame, bucket: str, instance_id: str, seq: Column | None = None) -> DataFrame:
    """Rows of `version_chains` with size, etag, content -> a document per
    version; delete markers are none."""
    col = F.col
    kept = chains.where(~col("deleted"))
    return envelope(
        kept, connector_id="s3", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit(f"s3://{bucket}/"), col("key"), F.lit("?versionId="), col("seq")), content=col("content"),
        content_type=mime_by_object_key(col("key")), seq=seq if seq is not None else F.monotonically_increasing_id(),
        version=col("etag"), cursor_value=iso(col("at"), "+00:00"), tags=["s3", f"bucket:{bucket}", "version"],
        metadata=meta(bucket=F.lit(bucket), key=col("key"), size=col("size"), etag=col("etag"),
                      valid_from=iso(col("at"), "+00:00"), valid_to=iso(col("until"), "+00:00"), is_latest=col("latest")))
