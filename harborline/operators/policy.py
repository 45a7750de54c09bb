"""Content policies as rows.

A policy is (policy_id, scope, field, operator, value, action, priority): it holds
for documents of the connector `scope`, or of all (`*`), whose `field` fits.  Of the
policies that hold for a document the one with the greatest priority decides,
ties by the smallest id; its action is `reject` or `allow`.

Fields: content_type, connector_id, instance_id, workspace_id, uri, domain (host of the
uri, lower-cased), extension, tag (any of the tags), size_bytes.  Operators: `eq`; `in`
(values separated by commas); `suffix` on domain (the domain itself or one below it);
`prefix`, `contains`, `regex` on texts; `gt`, `lt` on size_bytes.

Policies are reduced to keys and never looped over.  `eq`, `in` and `suffix` on domain are
keys as they stand.  A `prefix`, `suffix` or `contains` is a key that a document has if the
text of that length is a part of its own.  A `gt` or `lt` is a range of sizes, cut
into stretches of a power of two; a size lies in one stretch of each power.  A document
is dealt to the keys it has, and each is looked up in the table of keys, reduced to
the policy that would win there.  Only a `regex` has to be tried on every text: distinct
patterns meet distinct texts, pair by pair, on all executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.functions.names import extension, url_host
from harborline.operators.forest import lookup
from harborline.operators.validate import error
from harborline.session import materialize, spread

POLICY = "policy_id long, scope string, field string, operator string, value string, action string, priority int"
TEXTS = ("content_type", "connector_id", "instance_id", "workspace_id", "uri", "domain", "extension")
PARTS = ("prefix", "suffix", "contains")
#: Sizes are below two to this power.
BITS = 63


def _rank() -> Column:
    """Orders policies: the least one wins."""
    return F.struct((-F.col("priority")).cast("int").alias("order"), F.col("policy_id").cast("long").alias("policy_id"), "action")


def _facts(docs: DataFrame) -> DataFrame:
    """Thin columns of envelope rows that policies speak of."""
    ref = F.col("source_ref")
    host = F.regexp_replace(F.lower(url_host(ref["uri"])), r"^[^@]*@|:[0-9]+$", "")
    path = F.regexp_replace(F.regexp_replace(ref["uri"], r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*", "")
    return docs.select(
        "seq", "content_type", ref["connector_id"].alias("connector_id"), ref["instance_id"].alias("instance_id"),
        "workspace_id", ref["uri"].alias("uri"), host.alias("domain"), extension(path).alias("extension"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), "size_bytes")


def _key(scope: Column, operator: Column, field: Column, value: Column) -> Column:
    return F.concat_ws("\x1f", scope, operator, field, value)


def _keyed(policies: DataFrame) -> DataFrame:
    """(key, best): the policy that wins where a key applies."""
    value = F.when(F.col("field") == "domain", F.lower("value")).otherwise(F.col("value"))
    rows = policies.withColumn("value", value).where("operator in ('eq', 'in') or (operator = 'suffix' and field = 'domain')")
    rows = rows.withColumn("one", F.explode(F.when(F.col("operator") == "in", F.split("value", ","))
                                            .otherwise(F.array("value"))))
    name = F.when(F.col("operator") == "suffix", "suffix").otherwise("eq")
    bare = F.when(F.col("operator") == "suffix", F.regexp_replace("one", r"^\.", "")).otherwise(F.trim("one"))
    return rows.groupBy(_key(F.col("scope"), name, F.col("field"), bare).alias("key")).agg(F.min(_rank()).alias("best"))


def _keys(facts: DataFrame) -> DataFrame:
    """(seq, key): every key a document has."""
    pair = lambda operator, field, value: F.struct(F.lit(operator).alias("o"), F.lit(field).alias("f"), value.alias("v"))
    labels = F.split("domain", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels) - i + 1), "."))
    has = F.concat(
        F.array(*[pair("eq", f, F.col(f)) for f in TEXTS], pair("eq", "size_bytes", F.col("size_bytes").cast("string"))),
        F.transform(F.array_distinct("tags"), lambda t: pair("eq", "tag", t)),
        F.when(F.length("domain") > 0, F.transform(above, lambda d: pair("suffix", "domain", d)))
        .otherwise(F.array().cast("array<struct<o:string,f:string,v:string>>")))
    rows = facts.select("seq", F.array_distinct(F.array("connector_id", F.lit("*"))).alias("scopes"), F.explode(has).alias("h"))
    rows = rows.where("h.v is not null").select("seq", F.explode("scopes").alias("scope"), "h")
    return rows.where("scope is not null").select("seq", _key(F.col("scope"), F.col("h.o"), F.col("h.f"), F.col("h.v")).alias("key"))


def _refuse(rest: DataFrame) -> None:
    """Raises for the first policy whose operator, field or size is none."""
    size = F.col("field") == "size_bytes"
    fits = (size & F.col("operator").isin("gt", "lt")) | (F.col("field").isin(*TEXTS, "tag") & F.col("operator").isin(*PARTS, "regex"))
    bad = rest.where(~F.coalesce(fits, F.lit(False)) | (size & _size().isNull())).orderBy("policy_id").first()
    if bad is None:
        return
    if bad.field == "size_bytes" and bad.operator in ("gt", "lt"):
        raise ValueError(f"policy {bad.policy_id}: {bad.value!r} is no size")
    raise ValueError(f"policy {bad.policy_id}: {bad.operator!r} doesn't apply to {bad.field!r}")


def _size() -> Column:
    """A threshold, held to what sizes can be; null if the value is no whole number."""
    text = F.regexp_replace(F.regexp_replace("value", r"^\s+|\s+$", ""), r"(?<=\d)_(?=\d)", "")
    digits = F.regexp_replace(text, r"^[+-]?0*(?=\d)", "")
    least = F.when(F.startswith(text, F.lit("-")), F.lit(-1)).when(F.length(digits) > 18, F.lit((1 << 62) - 1)).otherwise(
        digits.try_cast("long"))
    return F.when(text.rlike(r"^[+-]?\d+$"), F.when(text.rlike(r"^-0+$"), F.lit(0)).otherwise(least))


def _scoped(facts: DataFrame, *columns: str) -> DataFrame:
    """`facts` once per scope they are in."""
    rows = facts.select("seq", *columns, F.explode(F.array_distinct(F.array("connector_id", F.lit("*")))).alias("scope"))
    return rows.where("scope is not null")


def _texts(facts: DataFrame, field: str) -> DataFrame:
    """(seq, connector_id, text) of a field; of each tag."""
    if field == "tag":
        rows = facts.select("seq", "connector_id", F.explode(F.array_distinct("tags")).alias("text"))
    else:
        rows = facts.select("seq", "connector_id", F.col(field).alias("text"))
    return rows.where("text is not null")


def _best(policies: DataFrame, *keys: Column | str) -> DataFrame:
    return policies.groupBy(*keys).agg(F.min(_rank()).alias("best"))


def _part_hits(facts: DataFrame, policies: DataFrame) -> list[DataFrame]:
    """(seq, best) by policies on parts of texts; one frame per operator and field."""
    asked = policies.where(F.col("operator").isin(*PARTS))
    # operators, fields and lengths of values: few however many policies there are
    lengths: dict = {}
    for r in asked.select("operator", "field", F.length("value").alias("n")).distinct().collect():
        lengths.setdefault((r.operator, r.field), []).append(r.n)
    out = []
    for (operator, field), ns in sorted(lengths.items()):
        text, n = F.col("text"), F.col("n")
        rows = _scoped(_texts(facts, field), "text").withColumn("n", F.explode(F.array(*map(F.lit, sorted(ns)))))
        rows = rows.where(n <= F.length(text))
        if operator == "prefix":
            part = F.substr(text, F.lit(1), n)
        elif operator == "suffix":
            part = F.substr(text, F.length(text) - n + 1, n)
        else:
            part = F.explode(F.array_distinct(F.transform(
                F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(text, i, n))))
        table = _best(asked.where((F.col("operator") == operator) & (F.col("field") == field)), "scope", F.col("value").alias("part"))
        out.append(rows.select("seq", "scope", part.alias("part")).join(table, ["scope", "part"]).select("seq", "best"))
    return out


def _size_hits(facts: DataFrame, policies: DataFrame) -> list[DataFrame]:
    """(seq, best) by policies on sizes.

    The sizes from `low` on are `low` itself and, for each bit that it lacks, the stretch
    that begins where this bit is set and the lower ones are not; those below `high`
    are, for each bit it has, the stretch in which that bit alone is taken away.
    """
    out = []
    for operator in ("gt", "lt"):
        rows = policies.where((F.col("field") == "size_bytes") & (F.col("operator") == operator)).withColumn(
            "at", _size() + (1 if operator == "gt" else 0)).where("at >= 0")
        most = rows.agg(F.max("at")).first()[0]
        if most is None:
            continue
        table = rows.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))))
        bare = F.expr("shiftright(at, bit)")
        if operator == "gt":
            table = _best(table.where(bare % 2 == 0), "scope", "bit", (bare + 1).alias("stretch")).unionByName(
                _best(rows, "scope", F.lit(-1).alias("bit"), F.col("at").alias("stretch")))
            # a stretch above the size's highest bit begins at nought and holds for none
            bits = F.sequence(F.lit(-1), F.length(F.bin("size_bytes")))
        else:
            table = _best(table.where(bare % 2 == 1), "scope", "bit", (bare - 1).alias("stretch"))
            bits = F.sequence(F.lit(0), F.lit(most.bit_length()))
        sizes = _scoped(facts, "size_bytes").where("size_bytes >= 0")
        # documents of a size in a scope fare alike
        asked = sizes.select("scope", "size_bytes").distinct().withColumn("bit", F.explode(bits)).withColumn(
            "stretch", F.when(F.col("bit") < 0, F.col("size_bytes")).otherwise(F.expr("shiftright(size_bytes, greatest(bit, 0))")))
        found = asked.join(table, ["scope", "bit", "stretch"]).groupBy("scope", "size_bytes").agg(F.min("best").alias("best"))
        out.append(sizes.join(found, ["scope", "size_bytes"]).select("seq", "best"))
    return out


def _regex_hits(facts: DataFrame, policies: DataFrame) -> list[DataFrame]:
    """(seq, best) by patterns; one frame per field."""
    asked = policies.where("operator = 'regex'")
    out = []
    for field in sorted(r.field for r in asked.select("field").distinct().collect()):
        patterns = _best(asked.where(F.col("field") == field), "scope", F.col("value").alias("pattern"))
        rows = _texts(facts, field)
        # The patterns are the outer loop, so that each is compiled once per task.
        tried = patterns.hint("shuffle_replicate_nl").join(
            rows.select("connector_id", "text").distinct(),
            F.expr("(scope = '*' or scope = connector_id) and rlike(text, pattern)"))
        found = tried.groupBy("connector_id", "text").agg(F.min("best").alias("best"))
        same = (rows["text"] == found["text"]) & rows["connector_id"].eqNullSafe(found["connector_id"])
        out.append(rows.join(found, same).select("seq", "best"))
    return out


def decisions(docs: DataFrame, policies: DataFrame) -> DataFrame:
    """(seq, policy_id, action, priority, error) for envelope rows a policy holds for;
    `error` is set where it rejects.  Content isn't read.

    Policies with an unknown field, operator or action are refused; null values
    and scopes hold for nothing.
    """
    policies = materialize(policies.where("value is not null and scope is not null"), "policies")
    if not policies.where("action is null or action not in ('reject', 'allow')").isEmpty():
        raise ValueError("a policy's action is reject or allow")
    facts = materialize(spread(_facts(docs)), "facts")
    known = "operator in ('eq', 'in') and field in ('{}')".format("', '".join((*TEXTS, "tag", "size_bytes")))
    rest = policies.where(f"not coalesce({known} or (operator = 'suffix' and field = 'domain'), false)")
    _refuse(rest)
    hits = lookup(materialize(_keys(facts), "keys"), _keyed(policies), "key", "inner").select("seq", "best")
    for more in (*_part_hits(facts, rest), *_size_hits(facts, rest), *_regex_hits(facts, rest)):
        hits = hits.unionByName(more)
    reason = F.concat(F.lit("Content policy violation: policy "), F.col("best.policy_id"))
    return hits.groupBy("seq").agg(F.min("best").alias("best")).select(
        "seq", "best.policy_id", "best.action", (-F.col("best.order")).alias("priority"),
        F.when(F.col("best.action") == "reject", error("ContentPolicyError", reason)).alias("error"))


def enforced(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Thin rows of a batch (seq, error and more) with a policy's error where no
    earlier rule has failed."""
    found = decided.where("error is not null").select("seq", F.col("error").alias("_policy"))
    return rows.join(found, "seq", "left").withColumn("error", F.coalesce("error", "_policy")).drop("_policy") \
        .select(rows.columns)
