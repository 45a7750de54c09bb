"""Rules of robots.txt files as a table, and urls tested against it.

Of a host's groups those with the longest name that is contained in the agent's
count, else those for `*`; groups with the same name are one.  Of the rules that match
a url's path and query the longest pattern decides, of equally long ones `Allow`;
no rule, no file and the file itself mean allowed.  `*` stands for any text, a
closing `$` for the end.

A pattern's text up to its first wildcard must be a prefix of the path.  A url is dealt to
those of its prefixes whose lengths occur among its host's rules, and each is looked up in
the table of (host, prefix); only wildcard rules found there are matched as expressions.
A host that owns most urls is looked up like any other key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from harborline.operators.forest import lookup
from harborline.session import materialize, once

_LINE = r"^\s*([A-Za-z-]+)\s*:\s*(.*?)\s*$"


def rules(files: DataFrame, agent: str = "*") -> DataFrame:
    """(host, allow, pattern) of the groups that count for `agent`, from landed
    files (host, body).  Comments, unknown and empty lines are passed over; an empty
    pattern is no rule.  A repeated host's files are read one after the other."""
    body = F.regexp_replace(F.coalesce("body", F.lit("")), "^﻿", "")
    lines = files.select(F.lower("host").alias("host"), F.xxhash64("body").alias("_file"), F.split(body, r"\r\n|\r|\n").alias("l")) \
        .select("host", "_file", F.posexplode("l").alias("pos", "line"))
    lines = once(lines, "line", F.regexp_replace("line", "#.*$", ""))
    parsed = lines.select("host", "_file", "pos", F.lower(F.regexp_extract("line", _LINE, 1)).alias("name"),
                          F.regexp_extract("line", _LINE, 2).alias("value")).where("name in ('user-agent', 'allow', 'disallow')")
    # a group begins with the first of some agents in a row; a file's lines fit a task
    order = Window.partitionBy("host", "_file").orderBy("pos")
    starts = (F.col("name") == "user-agent") & F.coalesce(F.lag("name").over(order) != "user-agent", F.lit(True))
    grouped = parsed.withColumn("_first", starts.cast("int")).withColumn("group", F.sum("_first").over(order))
    token = F.lower(F.regexp_extract("value", r"^(\*|[A-Za-z_-]*)", 1))
    named = grouped.where("name = 'user-agent'").select("host", "_file", "group", token.alias("token"))
    fits = named.where((F.col("token") == "*") | ((F.length("token") > 0) & F.contains(F.lit(agent.lower()), F.col("token"))))
    weight = F.when(F.col("token") == "*", 0).otherwise(F.length("token"))
    fits = fits.withColumn("weight", weight).withColumn("best", F.max("weight").over(Window.partitionBy("host"))) \
        .where("weight = best").select("host", "_file", "group").distinct()
    return grouped.where("name <> 'user-agent' and value <> ''").join(fits, ["host", "_file", "group"]).select(
        "host", (F.col("name") == "allow").alias("allow"), F.regexp_replace("value", r"\*+", "*").alias("pattern")).distinct()


def _regex(pattern: Column) -> Column:
    """A pattern with wildcards as an anchored expression."""
    body = F.regexp_replace(pattern, r"\$$", "")
    quoted = F.regexp_replace(body, r"([\\.+?()\[\]{}|^$])", r"\\$1")
    return F.concat(F.lit("(?s)^"), F.regexp_replace(quoted, r"\*", ".*"), F.when(F.endswith(pattern, F.lit("$")), r"\z").otherwise(""))


def url_target(url: Column) -> tuple[Column, Column]:
    """Host (lower-cased, without user) and path with query of a url."""
    bare = F.regexp_replace(url, r"#.*$", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?]*)", 1), "^[^@]*@", ""))
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*", "")
    return host, F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))


def allowed(urls: DataFrame, rule_table: DataFrame, url_col: str = "url") -> DataFrame:
    """`urls` with `allowed` and the deciding `rule` (null if none).  Null urls
    are not allowed.  Repeated urls are looked up once."""
    wild = F.contains("pattern", F.lit("*")) | F.endswith("pattern", F.lit("$"))
    prefix = F.regexp_replace(F.regexp_extract("pattern", r"^([^*]*)", 1), r"\$$", "")
    prefix = F.when(F.contains("pattern", F.lit("*")), F.regexp_extract("pattern", r"^([^*]*)", 1)).otherwise(prefix)
    table = materialize(rule_table.select("host", prefix.alias("prefix"), F.struct(
        F.length("pattern").alias("len"), F.col("allow"), "pattern", F.when(wild, _regex(F.col("pattern"))).alias("regex")).alias("r"))
        .groupBy("host", "prefix").agg(
            F.max(F.when(F.col("r.regex").isNull(), F.col("r"))).alias("plain"),
            F.array_compact(F.collect_set(F.when(F.col("r.regex").isNotNull(), F.col("r")))).alias("wild"))
        .withColumn("spot", F.concat_ws("\x1f", "host", "prefix")), "rules")
    lengths = table.groupBy("host").agg(F.sort_array(F.collect_set(F.length("prefix"))).alias("lengths"))
    host, path = url_target(F.col("url"))
    distinct = materialize(urls.select(F.col(url_col).alias("url")).where("url is not null").distinct()
                           .select("url", host.alias("host"), path.alias("path")), "urls")
    spots = lookup(distinct, lengths, "host", "inner").withColumn(
        "n", F.explode(F.filter("lengths", lambda n: n <= F.length("path")))) \
        .select("url", "path", F.concat_ws("\x1f", "host", F.substring(F.col("path"), F.lit(1), F.col("n"))).alias("spot"))
    met = lookup(materialize(spots, "spots"), table.select("spot", "plain", "wild"), "spot", "inner")
    hits = F.filter(F.concat(F.array("plain"), "wild"), lambda r: r.isNotNull() & (
        r.regex.isNull() | F.regexp_like(F.col("path"), r.regex)))
    best = met.select("url", F.array_max(hits).alias("best")).where("best is not null").groupBy("url").agg(F.max("best").alias("best"))
    told = distinct.join(best, "url", "left").select(
        F.col("url").alias("_url"), (F.coalesce("best.allow", F.lit(True)) | (F.col("path") == "/robots.txt")).alias("allowed"),
        F.when(F.col("path") != "/robots.txt", F.concat(F.when(F.col("best.allow"), "Allow: ").otherwise("Disallow: "), "best.pattern")).alias("rule"))
    return urls.join(told, F.col(url_col) == F.col("_url"), "left").withColumn("allowed", F.coalesce("allowed", F.lit(False))).drop("_url")
