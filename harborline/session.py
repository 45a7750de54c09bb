"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Settings that the operators' results rely on.  All are runtime settings, so
# they can be applied to a session somebody else has built.
SEMANTIC_CONF = {
    # ISO strings and epoch values are compared as text/number: one zone only.
    "spark.sql.session.timeZone": "UTC",
    # A later entry for the same key replaces the earlier one (header maps,
    # composite positions).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # State of the stateful stream operators lives in RocksDB, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Lets row_number() <= n keep only n rows per key before the shuffle, also
    # for the per-table row cap (100 000 by default).
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}

# Settings for sessions we build ourselves.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    **SEMANTIC_CONF,
}


def build_session(app: str = "harborline", master: str | None = None,
                  **conf: str) -> SparkSession:
    """A session with the engine's settings; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package; once per Spark application."""
    context = spark.sparkContext
    if getattr(context, "_harborline_shipped", False):
        return
    root = pathlib.Path(__file__).parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="harborline-")) / "harborline.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    # Workers the driver starts for itself, as for stateful stream operators,
    # do not see added files; they find the package where the driver did.
    known = context.environment.get("PYTHONPATH")
    context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, str(root.parent)]))
    context._harborline_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Make an existing session fit: the settings our results depend on, and
    the package on its workers."""
    ship_package(spark)
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in `spark.checkpoint.dir`.  Only a
    local-mode session, as in tests, may fall back to a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        base = os.environ.get("HARBORLINE_LOCAL_DIR") or tempfile.mkdtemp(prefix="harborline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where one result feeds several branches: the input is then scanned a
    single time, later reads are column-pruned, and a lost executor costs a
    re-read instead of a re-computation.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tasks per core that `spread` deals rows to.
SPREAD = 3


def spread(df: DataFrame) -> DataFrame:
    """Thin rows dealt evenly over tasks for all cores; also of a stream.

    A scan gives a row group to one task.  Where thin rows become wide or costly ones,
    a table of a few row groups would be the work of as many cores.
    """
    return df.repartition(SPREAD * df.sparkSession.sparkContext.defaultParallelism)


def once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """`df` with column `name`, evaluated exactly once per row.

    The optimizer copies a projected expression into every filter it pushes
    below the projection.  For a hash over the content or a JSON parse that
    means doing the work again per predicate.  A one-element explode is a
    fence predicates on its output stay above; it runs inside codegen.
    """
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(expr)).alias(name))
