"""One registered query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.llm import chat, decontaminate, katz, langid, neardup, ordinal, packing, periodic, pii, repair, rules, secrets, wavelet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build
    return register


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file on this machine's installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(n: int):
    """crc32 of the document id as text, modulo n; null ids count as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n)), F.lit(0))


def ratings(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 toxic, 1 of low quality, 2 good; unrated rows go."""
    return labels.select("doc_id", F.expr(
        "case when toxic = 1 then 0 when quality = 0 then 1 when quality = 1 then 2 end").alias("grade")) \
        .where("doc_id is not null and grade is not null")


@query("op1_ordinal_quality")
def op1(spark, root):
    docs = table(spark, root, "documents")
    rated = docs.select("doc_id", "text").join(sample_of(ratings(table(spark, root, "labels"))), "doc_id")
    model = ordinal.train(rated)
    return ordinal.score(docs, model, keep=[F.col("doc_id")]).withColumn(
        "kept", F.coalesce(F.col("tail_probability") >= 0.5, F.lit(True)))


def sample_of(rated: DataFrame) -> DataFrame:
    """About ordinal.SAMPLE ratings by a hash of their id, at most twice as
    many: few enough to be sent to all tasks that read documents."""
    share = min(1.0, ordinal.SAMPLE / max(rated.count(), 1))
    chosen = rated.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    return F.broadcast(chosen.limit(2 * ordinal.SAMPLE))


@query("op2_contextual_pii")
def op2(spark, root):
    return pii.digest(pii.spans(table(spark, root, "documents")))


@query("op3_katz_scores")
def op3(spark, root):
    return katz.scored(table(spark, root, "documents"), remainder(7) == 2)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op4_minhash_near_dedup", rf"""WITH RECURSIVE d AS (SELECT doc_id,
  regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS shingle
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, low) AS (SELECT doc_id, doc_id FROM d
  UNION SELECT e.y, r.low FROM reach r JOIN edges e ON e.x = r.doc_id WHERE r.low < e.y)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(low) AS component_id,
  min(low) = doc_id AS kept FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""")
def op4(spark, root):
    return neardup.near_duplicates(table(spark, root, "documents"))


@query("op5_chat_windows")
def op5(spark, root):
    rows = table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn int, role string, text string")
    return chat.formatted(rows.unionByName(more))


@query("op6_wavelet_shards")
def op6(spark, root):
    return wavelet.encoded_documents(table(spark, root, "documents"), vocabulary("word_bpe_49k.json"))


_NORMAL = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op7_benchmark_decontamination", f"""WITH d AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
b AS (SELECT item_id, {_NORMAL} AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS pattern
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) WHERE len(w) > 0),
x AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS pattern
  FROM d, (SELECT DISTINCT n FROM p) sizes, unnest(range(1, len(w) - n + 2)) t(i)),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM x JOIN p USING (pattern, n)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hits, unnest(range(i, i + n)) t(k) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op7(spark, root):
    return contaminated(table(spark, root, "documents"), table(spark, root, "benchmark"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    return decontaminate.contamination(docs, items).drop("hit_spans")


@query("op8_language_id")
def op8(spark, root):
    docs = table(spark, root, "documents")
    model = langid.train(docs.where(remainder(5) != 0))
    return langid.predict(docs, model, keep=[F.col("doc_id"), (remainder(5) == 0).alias("held_out")])


@query("op9_best_fit_packing")
def op9(spark, root):
    return packing.packed_documents(table(spark, root, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op10_quality_rules")
def op10(spark, root):
    trusted = table(spark, root, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return rules.judged(table(spark, root, "documents"), trusted)


@query("op11_periodic_runs")
def op11(spark, root):
    docs = periodic.with_planted_runs(table(spark, root, "documents").select("doc_id", "text"))
    return periodic.digest(periodic.periodic_runs(docs, keep=["doc_id"]))


@query("op12_structure_repair")
def op12(spark, root):
    rows = repair.damaged(table(spark, root, "conversations"))
    return repair.report(repair.repair(rows, gone="gone"), in_order=True)


@query("op13_linked_secrets")
def op13(spark, root):
    return secrets.digest(secrets.spans(table(spark, root, "documents")))
