"""Quality rules and a target-likeness ratio, in built-in functions only.

Base rules count words, symbols, repeated lines and repeated three-word windows
of every whole text inside its row.  The method compares two multinomials over
hashed n-grams (words and word pairs): one of documents somebody vouched for,
one of the whole corpus.  A document's likeness is the mean over its n-grams of
log(target / raw).

No document is scored by its own words: texts fall into `FOLDS` by their hash,
and the target a fold is held against is made of the others, so vouched-for and
other documents are on one scale.  The target is smoothed by as many n-grams of
the raw multinomial as it has itself.  A document is dropped if it is less like
the target than all but `SPARED` in a thousand of the vouched-for ones are.
Nothing of this is an absolute number, so one mix has one verdict at any size.

Counts are combined map-side into at most `BUCKETS` x (`FOLDS` + 1) rows per
task.  The ratios are a table of `BUCKETS` x `FOLDS` rows, the same size for any
corpus, joined to the n-grams by a broadcast.  They are whole millionths, so
sums are alike in every run; sums per document are combined where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.llm.runtime import prepare
from harborline.session import materialize

BUCKETS = 1 << 16
#: Parts of the corpus, each scored by a target made of the others.
FOLDS = 4
#: Vouched-for documents in a thousand that may be less like the target than the threshold.
SPARED = 1
#: Words from which on a vouched-for document counts for the threshold.
WORDS = 50
_UNIT, _STEP = 1_000_000, 100
#: Vouched ids sent to all tasks, at most; beyond that they are joined by a shuffle.
BROADCAST_IDS = 2_000_000

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_WORD = "[^\\x20\\x09-\\x0D]+"


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def with_hashes(rows: DataFrame, text: str) -> DataFrame:
    """`rows` with __h: 64-bit hashes of the words of each text, in order."""
    return rows.withColumn("__w", _words(F.coalesce(F.col(text), F.lit("")))) \
        .withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w))).drop("__w")


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def with_ngrams(rows: DataFrame) -> DataFrame:
    """`rows` with __g: the buckets of all words and word pairs of __h."""
    return rows.withColumn("__g", F.concat(
        F.transform("__h", _bucket),
        F.slice(F.transform("__h", lambda h, i: _bucket(F.xxhash64(h, F.get("__h", i + 1)))),
                F.lit(1), F.greatest(F.size("__h") - 1, F.lit(0)))))


def base_counts(rows: DataFrame, text: str) -> DataFrame:
    """`rows` (with __h) and word_chars, n_symbols, n_dup_lines, n_words,
    n_repeat_words.

    Repeated windows: the hashes of all windows are sorted with their places,
    equal neighbours are repeats, and each marks three words up to the next
    mark.  Texts whose windows are all distinct skip the sort.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = rows.withColumns({
        "word_chars": _without(body, SPACES).cast("long"),
        "n_symbols": (F.length(body) - _without(body, SYMBOLS)).cast("long"),
        "n_words": F.size("__h").cast("long"),
        "__lines": F.filter(F.split(body, "\n", -1), lambda x: _without(x, SPACES) > 0),
        "__v": F.slice(F.transform("__h", lambda h, i: F.xxhash64(h, F.get("__h", i + 1), F.get("__h", i + 2))),
                       F.lit(1), F.greatest(F.size("__h") - 2, F.lit(0)))})
    rows = rows.withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    rows = rows.withColumn("__s", F.when(
        F.size("__v") > F.size(F.array_distinct("__v")),
        F.sort_array(F.transform("__v", lambda v, i: F.struct(v.alias("v"), i.alias("i"))))))
    rows = rows.withColumn("__p", F.sort_array(F.transform(
        F.filter("__s", lambda x, k: F.coalesce(x.v == F.get("__s", k + 1).v, F.lit(False))
                 | F.coalesce(x.v == F.get("__s", k - 1).v, F.lit(False))), lambda x: x.i)))
    gaps = F.transform("__p", lambda p, k: F.least(F.coalesce(F.get("__p", k + 1) - p, F.lit(3)), F.lit(3)))
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))) \
        .drop("__lines", "__v", "__s", "__p")


def _vouched(trusted: DataFrame, id_col: str) -> DataFrame:
    """__v: the vouched ids, distinct, sent to all tasks if a count allows it."""
    ids = trusted.select(F.col(id_col).alias("__v")).where("__v is not null").distinct()
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _fold(text_hash: str) -> Column:
    return F.pmod(F.col(text_hash), F.lit(FOLDS)).cast("int")


def ratios(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """key, ratio: log(target / raw) in millionths for each bucket and fold,
    key being bucket x `FOLDS` + fold.  All are 0 for a fold whose target has
    no n-gram.

    `docs` has __id, __k (hash of the text) and __t (text), `ids` __v.
    """
    marked = docs.join(ids, F.col("__id") == F.col("__v"), "left")
    # An outer explode: for an inner one the optimizer infers a filter on the array's size and copies
    # the whole expression, hashes included, into it.
    grams = with_ngrams(with_hashes(marked, "__t")).select(
        F.when(F.col("__v").isNotNull(), _fold("__k")).alias("fold"), F.explode_outer("__g").alias("g"))
    counts = grams.where("g is not null").groupBy("g", "fold").agg(F.count("*").alias("n")).groupBy("g").agg(
        F.sum("n").alias("raw"), F.sum(F.when(F.col("fold").isNotNull(), F.col("n"))).alias("hit"),
        *[F.sum(F.when(F.col("fold") == f, F.col("n"))).alias(f"own{f}") for f in range(FOLDS)])
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("g"))
    counts = materialize(every.join(counts, "g", "left").na.fill(0), "counts")
    names = ["raw", "hit", *[f"own{f}" for f in range(FOLDS)]]
    total = counts.agg(*[F.sum(c).alias(c) for c in names]).first()
    p_raw = (F.col("raw") + 1) / F.lit(float(total.raw + BUCKETS))

    def ratio(f: int) -> Column:
        size = total.hit - total[f"own{f}"]
        if not size:
            return F.lit(0).cast("long")
        # p_target = (hit + size * p_raw) / (2 * size)
        p_target = (F.col("hit") - F.col(f"own{f}") + size * p_raw) / F.lit(2.0 * size)
        return F.round(F.log(p_target / p_raw) * _UNIT).cast("long")

    return counts.select("g", F.posexplode(F.array(*[ratio(f) for f in range(FOLDS)])).alias("f", "ratio")) \
        .select((F.col("g") * FOLDS + F.col("f")).alias("key"), "ratio")


def threshold(scores: DataFrame) -> float | None:
    """The likeness that all but `SPARED` in a thousand of the vouched-for
    documents of at least `WORDS` words reach, in steps of 0.0001 and at most
    0; None if there are no such documents.

    `scores` has total, n (n-grams), words and good.  No ratio is below log(1/2), and those
    above 0 share a step, so the histogram has at most 6 933 rows.
    """
    steps = scores.where(F.col("good") & (F.col("words") >= WORDS)).select(
        F.floor(F.least("total", F.lit(0)) / (F.col("n") * _STEP)).alias("step"))
    found = sorted((r.step, r["count"]) for r in steps.groupBy("step").count().collect())
    spared = sum(n for _, n in found) * SPARED // 1000
    for step, n in found:
        spared -= n
        if spared < 0:
            return step * _STEP / _UNIT
    return None


def judged(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (default: the id) of every row of `docs`, the five base
    counts, base_failed, likeness (mean log ratio) and kept.  `trusted` holds
    the vouched ids in `id_col`.

    Null text counts as empty: no words, likeness 0, base_failed.  Without
    trusted documents all ratios are 0, and without one of `WORDS` words there
    is no threshold: the base rules alone decide.  Repeated rows count and come
    back as often as they stand there.
    """
    prepare(docs.sparkSession)
    names = keep or [id_col]
    rows = docs.withColumns({"__t": F.col(text_col), "__id": F.col(id_col), "__k": F.xxhash64(text_col)})
    thin = rows.select("__id", "__k", "__t")
    ids = _vouched(trusted, id_col)
    # BUCKETS x FOLDS rows by construction, so the table is sent to all tasks.
    table = F.broadcast(ratios(thin, ids))
    scores = (with_ngrams(with_hashes(thin, "__t"))
              .select("__id", "__k", F.size("__h").alias("words"), F.explode_outer("__g").alias("g"))
              .select("__id", "__k", "words", (F.col("g") * FOLDS + _fold("__k")).alias("key")).join(table, "key")
              .groupBy("__id", "__k").agg(F.max("words").alias("words"), F.sum("ratio").alias("total"),
                                          F.count("*").alias("n")))
    scores = materialize(scores.join(ids, F.col("__id") == F.col("__v"), "left").select(
        F.col("__id").alias("__i"), F.col("__k").alias("__j"), "words", "total", "n",
        F.col("__v").isNotNull().alias("good")), "scores")
    least = threshold(scores)
    rows = base_counts(with_hashes(rows.select(*names, "__id", "__k", "__t"), "__t"), "__t").drop("__t", "__h")
    likeness = scores.select("__i", "__j", (F.col("total") / F.col("n") / _UNIT).alias("likeness"))
    rows = rows.join(likeness, F.col("__id").eqNullSafe(F.col("__i")) & F.col("__k").eqNullSafe(F.col("__j")),
                     "left").withColumn("likeness", F.coalesce("likeness", F.lit(0.0)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    alike = F.lit(True) if least is None else F.col("likeness") >= least
    return rows.withColumn("base_failed", failed).select(
        *names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "likeness",
        (~F.col("base_failed") & alike).alias("kept"))
