"""A corpus pipeline: each stage reads the Parquet table its predecessor wrote.

Language identification, near-duplicate removal, benchmark decontamination,
redaction of personal data, packing.  A stage takes (spark, docs, sf_dir); all
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.llm import decontaminate, langid, neardup, packing, pii
from harborline.llm.queries import remainder, table, vocabulary
from harborline.llm.runtime import prepare
from harborline.session import materialize, shared_dir

#: A document whose best language has a lower calibrated probability is rejected.
LEAST_SCORE = 0.5
#: Documents of this similarity in percent are near-duplicates.  30 bands of 5
#: rows: a pair of exactly that similarity is missed with probability 7e-6.
ALIKE, BANDS, ROWS = 80, 30, 5
#: Ids sent to all tasks, at most; beyond that they are joined by a shuffle.
BROADCAST_IDS = 1_000_000
KEY = "__row"


def _checked(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is known.  Rejected: no text, no letter, or a score
    below `LEAST_SCORE`."""
    model = langid.train(docs.where(remainder(5) != 0))
    told = langid.predict(docs, model)
    return told.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near copies.

    Compared are rows, known by a hash of their id and text: an id that comes
    with several texts keeps those that have no copy.  Rows without id take
    part and come last in their group.  Ties go by the hash.  Rows that repeat
    id and text are reduced to one; those with neither id nor words all stay.
    """
    keyed = docs.withColumn(KEY, F.xxhash64("doc_id", "text"))
    found = materialize(neardup.near_duplicates(
        keyed, id_col=KEY, percent=ALIKE, bands=BANDS, rows=ROWS), "found")
    rows = materialize(keyed.groupBy(KEY).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("m")), "rows")
    later = found.where("not kept").select(KEY, "component_id").distinct()
    linked = materialize(later.union(later.select(F.col("component_id"), "component_id").distinct()), "linked")
    # Minima are combined map-side: a group that owns most rows costs one row per task.
    first = rows.select(KEY, "doc_id").join(_checked(linked), KEY).groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", KEY)).alias("top")).select(f"top.{KEY}")
    gone = linked.select(KEY).join(first, KEY, "left_anti")
    often = rows.where("m > 1 and doc_id is not null").select(KEY)
    bare = _checked(rows.where("m > 1 and doc_id is null").select(KEY))
    often = _checked(often.union(found.where("n_shingles > 0").select(KEY).join(bare, KEY, "left_semi").distinct()))
    left = keyed.join(_checked(gone), KEY, "left_anti")
    once = left.join(often, KEY, "left_anti")
    again = left.join(often, KEY, "left_semi").groupBy(KEY).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")).select("row.*")
    return once.select(*docs.columns).unionByName(again)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that aren't contaminated by `benchmark`."""
    told = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), keep=docs.columns)
    return told.where("not contaminated").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, spans of personal data replaced by their kind; n_chars follows the text."""
    out = pii.redacted(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its sequence and place."""
    return packing.packed_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: Trained models, sketches and tokenizers: no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and reread."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
