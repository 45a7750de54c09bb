"""Secrets: base patterns, and weak parts of credentials that complete each other.

Everything is built-in functions.  Base kinds are regular expressions whose
matches are then checked.  Besides them there are parts which alone say little:
names of accounts (`id`), short or bare values (`key`) and addresses
(`endpoint`).  A base access identifier is a strong identifier, other base spans
are strong secrets.

Parts are intervals in scopes: a scope is a stretch of text between blank lines.
Two parts meet if they start within `REACH` characters in the same scope.  The
interval join deals parts to buckets of that width, keeps the least and greatest
start per bucket, role and strength, and joins every weak part to its own and the
two buckets beside it, so a bucket with thousands of parts costs no pairs.  A weak
part is reported only where the other roles make the credential whole:

    id        with a strong secret, or a weak secret and an endpoint
    key       with a strong identifier, or a weak identifier and an endpoint
    endpoint  with an identifier and a secret, strong or weak

Links depend on the text alone; they are worked out once per distinct text, so
copies of a text are no hot key, and come back to thin rows without the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from harborline.llm.pii import located, running
from harborline.llm.runtime import prepare
from harborline.session import materialize, once

BASE = ("assign", "access", "hex")
WEAK = ("id", "key", "endpoint")
KINDS = BASE + WEAK
#: Characters between the starts of two parts that belong together, at most.
REACH = 400
#: Texts with added spans that are sent to all tasks; beyond that they are joined by a shuffle.
BROADCAST_TEXTS = 100_000

_SET = "[\"']?+\\x20*+[:=]\\x20*+[\"']?+"
_ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?+\\x20*+[:=]\\x20*+[\"']?+([A-Za-z0-9+/_.=-]++)"
PATTERNS = {
    "assign": _ASSIGN,
    # a shorter run holds no match further in either, so the least length may stand in the pattern
    "access": "AKIA[A-Z0-9]{14,}+",
    "hex": "(?<![0-9a-f])[0-9a-f]{16,}+",
    "id": "(?<![A-Za-z0-9])(?i:access[_-]?key(?:[_-]?id)?|client[_-]?id|account(?:[_-]?id)?|user(?:[_-]?name)?|login)"
          + _SET + "[A-Za-z0-9._@+-]++|(?<![A-Z0-9])(?:ASIA|AIDA|AROA|AGPA)[A-Z0-9]{12,}+",
    "key": "(?i:(?<![A-Za-z0-9])(?:secret[_-]?access[_-]?key|secret[_-]?key|private[_-]?key|pass(?:word|wd)?|pwd|secret"
           "|token|api_?key))" + _SET + "[^\\x20\\x09-\\x0D\"',;]++"
           "|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])"
           "[A-Za-z0-9+/_-]{20,}+={0,2}+",
    "endpoint": "(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\\x20\\x09-\\x0D\"'<>]++"
                "|(?<![A-Za-z0-9])(?i:host(?:[_-]?name)?|endpoint|server)" + _SET + "[A-Za-z0-9.-]++(?::[0-9]++)?+",
}
#: A short look whether a text can have any.
_HINT = {
    "assign": "(?i:passw|secret|token|api_?key)", "access": "AKIA[A-Z0-9]{14}", "hex": "[0-9a-f]{16}",
    "id": "(?i:access[_-]?key|client[_-]?id|account|user|login)|A(?:SIA|IDA|ROA|GPA)[A-Z0-9]{12}",
    "key": "(?i:pass|pwd|secret|token|_?key)|[A-Za-z0-9+/_-]{20}", "endpoint": "://|(?i:host|endpoint|server)",
}
_BREAK = "\\n[\\x20\\x09\\x0D]*+(?=\\n)"
_SPAN = "array<struct<s: bigint, e: bigint, k: string>>"


def base_spans(rows: DataFrame, text: str) -> DataFrame:
    """`rows` with one column of (s, e, t) per base kind.  `text` has no nulls."""
    for kind in BASE:
        rows = located(rows, text, PATTERNS[kind], F.col(text).rlike(_HINT[kind]), kind)
    # a match whose value is short is passed over, not tried again further in
    return once(rows, "assign", F.filter("assign", lambda x: F.length(F.regexp_extract(x.t, _ASSIGN, 1)) >= 12))


def _named(kind: str) -> Column:
    return F.transform(kind, lambda x: F.struct(x.s.alias("s"), x.e.alias("e"), F.lit(kind).alias("k")))


def weak_parts(rows: DataFrame, text: str) -> DataFrame:
    """`rows` (with the columns of `base_spans`) and `parts`: all parts and scope
    breaks of a text that holds an identifier and a secret, as (s, e, k, scope)
    by place; null if nothing can complete anything."""
    for kind in ("id", "key"):
        rows = located(rows, text, PATTERNS[kind], F.col(text).rlike(_HINT[kind]), kind)
    rows = once(rows, "__both", (F.size("access") + F.size("id") > 0) & (F.size("assign") + F.size("hex") + F.size("key") > 0))
    rows = located(rows, text, PATTERNS["endpoint"], F.col("__both") & F.col(text).rlike(_HINT["endpoint"]), "endpoint")
    rows = once(rows, "__both", F.col("__both") & (F.size("id") + F.size("key") + F.size("endpoint") > 0))
    rows = located(rows, text, _BREAK, F.col("__both"), "break")
    rows = once(rows, "__p", F.when(F.col("__both"), F.sort_array(F.concat(*map(_named, (*KINDS, "break"))))))
    rows = once(rows, "__b", F.transform("__p", lambda p: F.when(p.k == "break", 1).otherwise(0).cast("bigint")))
    rows = once(rows, "__n", running("__b"))
    return once(rows, "parts", F.zip_with("__p", "__n", lambda p, n: F.struct(
        p.s.alias("s"), p.e.alias("e"), p.k.alias("k"), n.alias("scope")))).drop(
            "__both", "__p", "__b", "__n", "break", *WEAK)


def linked(parts: DataFrame, key: str, reach: int = REACH) -> DataFrame:
    """Weak parts (key, s, e, k) that complementary parts in reach complete, of
    rows (key, s, e, k, scope)."""
    # a weak part that touches a base span or a part before it is no part of its own
    place = Window.partitionBy(key).orderBy("s", "e", "k")
    is_base = F.col("k").isin(*BASE)
    rows = parts.where("k <> 'break'").withColumn(
        "before", F.max("e").over(place.rowsBetween(Window.unboundedPreceding, -1))) \
        .withColumn("behind", F.min(F.when(is_base, F.col("s"))).over(place.rowsBetween(1, Window.unboundedFollowing)))
    rows = rows.where(is_base | ~(F.coalesce(F.col("before") > F.col("s"), F.lit(False))
                                  | F.coalesce(F.col("behind") < F.col("e"), F.lit(False))))
    role = F.when(F.col("k").isin("access", "id"), "id").when(F.col("k") == "endpoint", "endpoint").otherwise("key")
    rows = rows.select(key, "scope", "s", "e", "k", role.alias("role"), is_base.alias("strong"),
                       F.floor(F.col("s") / reach).alias("bucket"))
    ends = rows.groupBy(key, "scope", "bucket", "role", "strong").agg(F.min("s").alias("low"), F.max("s").alias("high"))
    ends = ends.select(F.col(key).alias("key_"), F.col("scope").alias("scope_"), F.col("role").alias("other"), "strong",
                       F.col("low"), F.col("high"),
                       F.explode(F.sequence(F.col("bucket") - 1, F.col("bucket") + 1)).alias("near"))
    weak = rows.where(~F.col("strong")).drop("strong")
    met = weak.join(ends, (F.col(key) == F.col("key_")) & (F.col("scope") == F.col("scope_"))
                    & (F.col("bucket") == F.col("near")) & (F.col("role") != F.col("other")))
    met = met.where((F.abs(F.col("low") - F.col("s")) <= reach) | (F.abs(F.col("high") - F.col("s")) <= reach))
    seen = met.groupBy(key, "s", "e", "k").agg(
        *[F.max((F.col("other") == o) & (F.lit(True) if not strong else F.col("strong"))).alias(name)
          for name, o, strong in (("strong_id", "id", True), ("any_id", "id", False), ("strong_key", "key", True),
                                  ("any_key", "key", False), ("at", "endpoint", False))])
    whole = F.when(F.col("k") == "id", F.expr("strong_key or (any_key and at)")) \
        .when(F.col("k") == "key", F.expr("strong_id or (any_id and at)")).otherwise(F.expr("any_id and any_key"))
    return seen.where(whole).select(key, "s", "e", "k")


def spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
          reach: int = REACH) -> DataFrame:
    """`keep` columns (default: the id) of every row, one array of (s, e, t) per
    base kind, and `found`: all spans (s, e, k), base ones and those added, by
    start and then kind in the order of `KINDS`.

    A span of `assign` is the whole match, name and value.  Added spans never
    overlap base ones nor one another.  Null text counts as empty.  Repeated
    rows give repeated rows; the id may be null or repeated, as links go by text.
    Columns named as results are replaced.  Empty table: no rows.
    """
    prepare(docs.sparkSession)
    names = [c for c in (keep or [id_col]) if c not in (*BASE, "found")]
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(names)], body.alias("__t"))
    rows = weak_parts(base_spans(rows, "__t"), "__t")
    rows = rows.withColumn("__h", F.when(F.col("parts").isNotNull(), F.sha2("__t", 256))).drop("__t")
    thin = materialize(rows, "secrets")
    some = thin.where("__h is not null").select("__h", "parts").dropDuplicates(["__h"]) \
        .select("__h", F.explode("parts").alias("p")).select("__h", "p.*")
    more = materialize(linked(some, "__h", reach).groupBy("__h").agg(
        F.collect_list(F.struct("s", "e", "k")).alias("__more")), "linked").withColumnRenamed("__h", "__j")
    near = F.broadcast(more) if more.count() <= BROADCAST_TEXTS else more
    none = F.array().cast(_SPAN)
    rest = thin.where("__h is null").withColumn("__more", none)
    told = thin.where("__h is not null").join(near, F.col("__h") == F.col("__j"), "left").drop("__j") \
        .withColumn("__more", F.coalesce("__more", none))
    return rest.unionByName(told).select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(names)], *BASE,
        _ordered(F.concat(*map(_named, BASE), "__more")).alias("found"))


def _ordered(all_spans: Column) -> Column:
    place = F.array(*map(F.lit, KINDS))
    keyed = F.transform(all_spans, lambda x: F.struct(
        x.s.alias("s"), F.array_position(place, x.k).alias("p"), x.e.alias("e"), x.k.alias("k")))
    return F.transform(F.sort_array(keyed), lambda x: F.struct(x.s.alias("s"), x.e.alias("e"), x.k.alias("k")))


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x.k, x.s, x.e)), ",")


def digest(rows: DataFrame) -> DataFrame:
    """Counts of base spans, base_sha256 and spans as text, for rows of `spans`."""
    names = [c for c in rows.columns if c not in (*BASE, "found")]
    return rows.select(
        *names, *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(_ordered(F.concat(*map(_named, BASE)))), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"))
