"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Everything is built-in functions.  Base kinds are regular expressions whose
matches are then checked (parts, digits, Luhn).  Their loops are possessive and
start only where a run starts or the last match ended, which finds the same
leftmost matches in one pass over any text.

Bootstrapping: tokens with a digit or an at sign are candidates; the words
beside them are patterns.  Base entities are the seeds.  Patterns and instances
form a graph that is scored in rounds: a pattern's confidence for a kind is the
mean score of its distinct instances.  A seed scores 1 for its kind and 0 for
others; an unseen instance scores the noisy-or of the confidences of its *other*
patterns, so no pattern vouches for itself, and one that cannot be of the kind by its letters and digits
scores 0.  Confidence thus rises over the
rounds where both sides of an unseen identifier agree, and is cut off only at
the end: candidates beside a pattern of high confidence are added with its kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.llm.runtime import prepare
from harborline.session import materialize, once

KINDS = ("email", "ip", "card", "phone")
#: A pattern adds candidates from this confidence and so many distinct seeds on.
CONFIDENCE, SUPPORT, ROUNDS = 0.9, 5, 5
#: Share of seeds of one kind from which on a pattern is scored at all.
FLOOR = 0.5
#: Digits that an unseen instance has at least; one of an address has a letter.
DIGITS = {"ip": 4, "card": 12, "phone": 7}
#: Added spans sent to all tasks, at most; beyond that documents are shuffled to them.
BROADCAST_SPANS = 200_000
#: Characters on each side in which a context word is looked for.
CONTEXT = 64

_LOCAL = "[A-Za-z0-9._%+-]"
_RUN = "(?:(?<!{0})|\\G)"
PATTERNS = {
    "email": _RUN.format(_LOCAL) + _LOCAL + "++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": _RUN.format("[0-9]") + "[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?+[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_CANDIDATE = "(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D0-9@]*+[0-9@][^\\x20\\x09-\\x0D]*+"
_STEP = 256


def running(sizes: str) -> Column:
    """Running totals of a column of whole numbers, in blocks, so that no
    growing array is copied more than `_STEP` times."""
    def totals(x: Column) -> Column:
        zero = F.struct(F.array().cast("array<bigint>").alias("a"), F.lit(0).cast("bigint").alias("t"))
        return F.aggregate(x, zero, lambda acc, v: F.struct(
            F.array_append(acc.a, acc.t + v).alias("a"), (acc.t + v).alias("t")), lambda acc: acc.a)

    last = F.floor((F.size(sizes) - 1) / F.lit(_STEP)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: totals(F.slice(sizes, b * _STEP + 1, F.lit(_STEP))))
    joined = F.aggregate(
        blocks, F.struct(F.array().cast("array<array<bigint>>").alias("a"), F.lit(0).cast("bigint").alias("t")),
        lambda acc, x: F.struct(
            F.array_append(acc.a, F.transform(x, lambda v: v + acc.t)).alias("a"),
            (acc.t + F.element_at(x, -1)).alias("t")), lambda acc: F.flatten(acc.a))
    return F.when(F.size(sizes) > 0, joined).otherwise(F.array().cast("array<bigint>"))


def located(rows: DataFrame, text: str, pattern: str, needs: Column, out: str) -> DataFrame:
    """`rows` with `out`: the matches of `pattern` as (s, e, t), in characters,
    end exclusive.  `needs`: rows that can have any."""
    rows = once(rows, "__m", F.when(needs, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
                .otherwise(F.array().cast("array<string>")))
    rows = once(rows, "__n", F.when(
        F.size("__m") > 0,
        F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size("__m")), "__m",
                   lambda gap, m: (F.length(gap) + F.length(m)).cast("bigint")))
        .otherwise(F.array().cast("array<bigint>")))
    rows = once(rows, "__e", running("__n"))
    return once(rows, out, F.zip_with("__m", "__e", lambda m, e: F.struct(
        (e - F.length(m)).alias("s"), e.alias("e"), m.alias("t")))).drop("__m", "__n", "__e")


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    """Whether a string of digits passes: every second one from the right
    doubled, its digits added."""
    n = F.length(d)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(d, i, F.lit(1)).cast("int")
                         * F.when((n - i) % 2 == 1, 2).otherwise(1))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v - F.when(v > 9, 9).otherwise(0)) % 10 == 0


def _valid(kind: str, t: Column) -> Column:
    if kind == "ip":
        return t.rlike(f"^{_PART}(?:\\.{_PART}){{3}}$")
    if kind == "card":
        d = _digits(t)
        return F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(t)).between(10, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda x: _valid(kind, x.t)


def _named(kind: str):
    return lambda x: F.struct(x.s.alias("s"), x.e.alias("e"), F.lit(kind).alias("k"))


def base_spans(rows: DataFrame, text: str) -> DataFrame:
    """`rows` with one column of (s, e, t) per kind.  `text` has no nulls."""
    rows = once(rows, "__d", F.col(text).rlike("[0-9]"))
    digit = F.col("__d")
    needs = {"email": F.instr(text, "@") > 0, "ip": digit, "card": digit,
             "phone": digit & (F.instr(text, "+") > 0)}
    for kind in KINDS:
        rows = located(rows, text, PATTERNS[kind], needs[kind], kind)
        if kind != "email":
            rows = once(rows, kind, F.filter(kind, _check(kind)))
    return rows.drop("__d")


def _word(piece: Column, last: bool) -> Column:
    """The lower-cased word of a stretch of text that is next to a candidate."""
    near = F.substring(piece, -CONTEXT, CONTEXT) if last else F.substring(piece, 1, CONTEXT)
    words = F.filter(F.split(F.lower(near), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return F.coalesce(F.get(words, F.size(words) - 1 if last else F.lit(0)), F.lit(""))


def occurrences(rows: DataFrame, text: str) -> DataFrame:
    """One row per candidate token: the columns of `rows` but text and kinds,
    s, e, instance (lower-cased), kind (of the base span it touches, if any),
    left and right (context words)."""
    keep = [c for c in rows.columns if c not in (text, *KINDS)]
    rows = once(rows, "__all", _base())
    has = F.col(text).rlike("[0-9@]")
    rows = located(rows.where(has), text, _CANDIDATE, F.lit(True), "__c")
    rows = once(rows, "__gap", F.split(text, _CANDIDATE, -1))
    rows = once(rows, "__x", F.transform("__c", lambda c, i: F.struct(
        c.s.alias("s"), c.e.alias("e"), F.lower(c.t).alias("instance"),
        F.get(F.filter("__all", lambda a: (a.s < c.e) & (a.e > c.s)), F.lit(0)).k.alias("kind"),
        _word(F.get("__gap", i), True).alias("left"), _word(F.get("__gap", i + 1), False).alias("right"))))
    return rows.select(*keep, F.explode_outer("__x").alias("x")).where("x is not null").select(*keep, "x.*")


def _plausible() -> Column:
    """Whether `instance` can be of `kind` by what it is made of."""
    kind, instance = F.col("kind"), F.col("instance")
    out = F.when(kind == "email", instance.rlike("\\p{L}"))
    for k, n in DIGITS.items():
        out = out.when(kind == k, F.length(_digits(instance)) >= n)
    return out


def confident(found: DataFrame, *, confidence: float = CONFIDENCE, support: int = SUPPORT,
              rounds: int = ROUNDS) -> DataFrame:
    """Patterns (side, word, kind, confidence) that add candidates, from the
    graph of all occurrences.

    Counts are over distinct instances, combined before they are shuffled.  A
    pattern takes part with `support` seeds of a kind that are at least `FLOOR`
    of all its instances.  Only edges from such patterns to unseen instances go
    through the rounds; each round is a table in the shared folder, and they
    end early when no confidence moves.
    """
    sides = F.explode(F.array(
        F.struct(F.lit("L").alias("side"), F.col("left").alias("word")),
        F.struct(F.lit("R").alias("side"), F.col("right").alias("word"))))
    graph = materialize(found.select(sides.alias("p"), "instance", "kind").where("p.word <> ''")
                        .groupBy("p.side", "p.word", "instance").agg(F.max("kind").alias("seed")), "graph")
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("seeds")) for k in KINDS]))
    patterns = materialize(
        graph.groupBy("side", "word").agg(F.count("*").alias("n"), *[
            F.count(F.when(F.col("seed") == k, 1)).alias(k) for k in KINDS])
        .select("side", "word", "n", kinds.alias("x")).select("side", "word", "n", "x.*")
        .withColumn("confidence", F.col("seeds") / F.col("n"))
        .where((F.col("seeds") >= support) & (F.col("confidence") >= FLOOR)), "patterns")
    if patterns.isEmpty():
        return patterns.select("side", "word", "kind", "confidence")
    edges = materialize(graph.where("seed is null").join(patterns, ["side", "word"]).select(
        "side", "word", "kind", "instance").where(_plausible()), "edges")
    for _ in range(rounds - 1):
        # log of the chance that a pattern errs; sums of it are a noisy-or
        doubt = F.log(1 - F.least("confidence", F.lit(0.999)))
        told = edges.join(patterns.select("side", "word", "kind", doubt.alias("doubt")), ["side", "word", "kind"])
        every = told.groupBy("instance", "kind").agg(F.sum("doubt").alias("all"))
        gains = told.join(every, ["instance", "kind"]).groupBy("side", "word", "kind").agg(
            F.sum(1 - F.exp(F.least(F.col("all") - F.col("doubt"), F.lit(0.0)))).alias("gain"))
        patterns = materialize(patterns.join(gains, ["side", "word", "kind"], "left").select(
            "side", "word", "kind", "n", "seeds",
            ((F.col("seeds") + F.coalesce("gain", F.lit(0.0))) / F.col("n")).alias("confidence"),
            F.col("confidence").alias("before")), "patterns")
        if patterns.where(F.col("confidence") - F.col("before") > 1e-6).isEmpty():
            break
    return patterns.where(F.col("confidence") >= confidence).select("side", "word", "kind", "confidence")


def spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
          confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """`keep` columns (default: the id) of every row, one array of (s, e, t)
    per kind, and `found`: all spans (s, e, k), base ones and those added, by
    start and then kind in the order of KINDS.

    Added spans never touch base ones.  Null text counts as empty.  Repeated
    rows give repeated rows.  Empty table: no rows.
    """
    prepare(docs.sparkSession)
    names = keep or [id_col]
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(names)],
                       F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__h"), body.alias("__t"))
    based = base_spans(rows, "__t")
    seen = materialize(occurrences(based.select("__id", "__h", "__t", *KINDS), "__t"), "occurrences")
    patterns = confident(seen, confidence=confidence, support=support)
    free = seen.where("kind is null").drop("kind")
    more = free.join(patterns.where("side = 'L'").withColumnRenamed("word", "left"), "left").unionByName(
        free.join(patterns.where("side = 'R'").withColumnRenamed("word", "right"), "right"))
    more = more.where(_plausible())
    # one kind per token: of the most confident pattern, ties by name
    more = more.groupBy("__id", "__h", "s", "e").agg(
        F.min_by("kind", F.struct(-F.col("confidence"), "kind")).alias("k"))
    more = more.groupBy("__id", "__h").agg(F.collect_list(F.struct("s", "e", "k")).alias("__more")) \
        .withColumnsRenamed({"__id": "__i", "__h": "__j"})
    more = materialize(more, "added")
    if (more.agg(F.sum(F.size("__more")).alias("n")).first().n or 0) <= BROADCAST_SPANS:
        more = F.broadcast(more)
    joined = based.drop("__t").join(
        more, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__h") == F.col("__j")), "left")
    return joined.select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(names)], *KINDS,
        _ordered(F.concat(_base(), F.coalesce("__more", F.array().cast(
            "array<struct<s: bigint, e: bigint, k: string>>")))).alias("found"))


def _base() -> Column:
    return F.concat(*[F.transform(k, _named(k)) for k in KINDS])


def _ordered(all_spans: Column) -> Column:
    place = F.array(*map(F.lit, KINDS))
    keyed = F.transform(all_spans, lambda x: F.struct(
        x.s.alias("s"), F.array_position(place, x.k).alias("p"), x.e.alias("e"), x.k.alias("k")))
    return F.transform(F.sort_array(keyed), lambda x: F.struct(x.s.alias("s"), x.e.alias("e"), x.k.alias("k")))


def listed(found: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x.k, x.s, x.e)), ",")


def digest(rows: DataFrame) -> DataFrame:
    """Counts of base spans, base_sha256 and spans as text, for rows of `spans`."""
    names = [c for c in rows.columns if c not in (*KINDS, "found")]
    return rows.select(
        *names, *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(_ordered(_base())), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def redacted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with every span replaced by its kind in brackets.  Spans
    that overlap are one, named after the first.  Texts without spans, nulls
    among them, stay as they are."""
    columns = docs.columns
    rows = spans(docs, id_col=id_col, text_col=text_col, keep=columns, **options)
    merged = F.aggregate("found", F.array().cast("array<struct<s: bigint, e: bigint, k: string>>"), lambda a, x: (
        F.when((F.size(a) > 0) & (x.s < F.element_at(a, -1).e),
               F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
                   F.element_at(a, -1).s.alias("s"), F.greatest(F.element_at(a, -1).e, x.e).alias("e"),
                   F.element_at(a, -1).k.alias("k")))))
        .otherwise(F.array_append(a, x))))
    rows = once(rows.drop(*KINDS), "__m", F.when(F.size("found") > 0, merged))
    text = F.col(text_col)
    parts = F.transform("__m", lambda x, i: F.concat(
        F.substring(text, F.coalesce(F.get("__m", i - 1).e, F.lit(0)).cast("int") + 1,
                    (x.s - F.coalesce(F.get("__m", i - 1).e, F.lit(0))).cast("int")),
        F.lit("["), F.upper(x.k), F.lit("]")))
    tail = F.substring(text, F.element_at("__m", -1).e.cast("int") + 1, F.lit(2147483647))
    new = F.when(F.col("__m").isNotNull(), F.concat(F.array_join(parts, ""), tail)).otherwise(text)
    return rows.select(*[new.alias(c) if c == text_col else F.col(c) for c in columns])
