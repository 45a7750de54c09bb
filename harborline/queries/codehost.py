"""Code-host resources, derived from orders, lineitem and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions.classify import pull_state
from harborline.operators.filters import issue_not_pull, pull_wanted, release_wanted
from harborline.operators.joins import file_blobs
from harborline.queries import derive as D
from harborline.queries.core import PATHS_SQL, paths
from harborline.queries.registry import Tables, query
from harborline.session import spread
from harborline.sources import codehost as S
from harborline.sources.common import iso, landed

# ---------------------------------------------------------------------- files


def tree(t: Tables):
    p = paths(t)
    return p.select(
        "doc_id", F.concat(F.lit("o/"), F.regexp_extract("path", r"(src\d+)", 1)).alias("repo"),
        F.lit("main").alias("branch"), F.md5(F.lit("tree")).alias("tree_sha"), "path",
        F.when(F.col("doc_id") % 17 == 0, "tree").otherwise("blob").alias("type"),
        F.sha1(F.encode("text", "UTF-8")).alias("sha"), "size")


def blobs(t: Tables):
    """Blobs by content: base64 in lines, plain, or in an unknown encoding."""
    d = t.documents.groupBy(F.sha1(F.encode("text", "UTF-8")).alias("sha")).agg(
        F.first("text").alias("text"))
    kind = F.pmod(F.length("text"), F.lit(9))
    return d.select("sha", F.when(kind == 0, "rot13").when(kind < 4, "utf-8").otherwise("base64").alias("encoding"),
                    F.when(kind < 4, F.col("text")).otherwise(F.base64(F.encode("text", "UTF-8"))).alias("content"))


CODE_DROP = "('.png', '.gz', '.pdf')"
FILES_SQL = PATHS_SQL + f""",
wanted AS (SELECT *, 'o/' || source AS repo FROM exts WHERE doc_id % 17 <> 0 AND ext NOT IN {CODE_DROP}
  AND size <= 30000 AND (path GLOB '*.py' OR path GLOB '*.md' OR path GLOB 'v1.2/*'))"""


@query("src_code_files", f"""WITH {FILES_SQL} SELECT sha256('h1:https://github.com/' || repo || '/blob/main/' || path) AS id,
  sha1(text) AS version, sha256(text) AS checksum, 'file|repo:' || repo || '|branch:main' AS tags,
  CASE ext WHEN '.py' THEN 'text/x-python' WHEN '.md' THEN 'text/markdown' ELSE 'application/octet-stream' END AS content_type,
  md5('tree') AS cursor_value FROM wanted WHERE length(text) % 9 <> 0""")
def src_code_files(t: Tables):
    entries = S.wanted_files(tree(t), ["*.py", "*.md", "v1.2/*"], max_bytes=30000)
    docs = S.files(entries, blobs(t), "h1", seq=F.col("doc_id"))
    return docs.select("id", "source_ref.version", "checksum", F.array_join("tags", "|").alias("tags"),
                       "content_type", F.col("cursor.value").alias("cursor_value"))


@query("jn_file_blob", f"WITH {PATHS_SQL} SELECT doc_id, path, length(text)::BIGINT AS chars FROM paths")
def jn_file_blob(t: Tables):
    d = t.documents.groupBy(F.sha1(F.encode("text", "UTF-8")).alias("sha")).agg(F.first("text").alias("text"))
    return file_blobs(tree(t), d).select("doc_id", "path", F.length("text").cast("bigint").alias("chars"))


# --------------------------------------------------------------------- issues

login = lambda c: F.struct(c.alias("login"))


def _dated(rows, c: str):
    """Rows dealt to all cores, with the text of a date, written once, as `_day`."""
    return spread(rows).withColumn("_day", iso(F.col(c), "Z"))


def issues(t: Tables):
    k = F.col("o_orderkey")
    payload = F.to_json(F.struct(
        k.alias("number"), F.concat(F.lit("Order "), k).alias("title"),
        F.when(k % 3 != 0, F.col("o_orderpriority")).alias("body"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
        F.concat(F.lit("https://github.com/o/r/issues/"), k).alias("html_url"),
        F.col("_day").alias("created_at"), F.col("_day").alias("updated_at"),
        login(F.concat(F.lit("u"), "o_custkey")).alias("user"),
        F.array(F.struct(F.col("o_orderpriority").alias("name"))).alias("labels"),
        F.when(k % 4 == 0, F.struct(F.lit("M1").alias("title"))).alias("milestone"),
        F.when(k % 10 == 0, F.struct(F.lit("x").alias("url"))).alias("pull_request")))
    return landed(_dated(t.orders, "o_orderdate").select(k, F.lit("o/r").alias("repo"), payload.alias("payload")), S.ISSUE)


def comments(t: Tables, where: str = "true"):
    l = _dated(t.lineitem.where(where), "l_shipdate")
    payload = F.to_json(F.struct(
        login(F.concat(F.lit("s"), "l_suppkey")).alias("user"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("body"),
        F.concat(F.lit("f"), "l_partkey").alias("path"), F.col("l_linenumber").alias("line"),
        F.col("_day").alias("created_at"), F.col("_day").alias("updated_at")))
    return (landed(l.select(F.lit("o/r").alias("repo"), F.col("l_orderkey").alias("number"),
                            payload.alias("payload")), S.COMMENT).withColumnRenamed("p", "c")
            .drop("payload"))


BODY_SQL = "l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity"
COMMENTS_SQL = f"""cm AS (SELECT l_orderkey AS number, count(*) AS n,
  string_agg({BODY_SQL}, ',' ORDER BY l_shipdate, {BODY_SQL}) AS bodies FROM lineitem GROUP BY 1)"""


def bodies(c: str):
    return F.array_join(F.transform(c, lambda x: x["body"]), ",")


@query("jn_issue_comments", f"""WITH {COMMENTS_SQL} SELECT o_orderkey AS number, coalesce(n, 0) AS n_comments,
  coalesce(bodies, '') AS bodies FROM orders LEFT JOIN cm ON number = o_orderkey WHERE o_orderkey % 10 <> 0""")
def jn_issue_comments(t: Tables):
    return S.issues_with_comments(issues(t), comments(t)).select(
        "number", F.col("comments_count").alias("n_comments"), bodies("comments").alias("bodies"))


@query("src_code_issues", f"""WITH {COMMENTS_SQL} SELECT o_orderkey AS number,
  sha256('h1:https://github.com/o/r/issues/' || o_orderkey) AS id,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS version,
  'issue|repo:o/r|state:' || CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END AS tags,
  'Order ' || o_orderkey AS title, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE '' END AS body,
  CASE WHEN o_orderkey % 4 = 0 THEN 'M1' END AS milestone, coalesce(n, 0) AS n_comments
FROM orders LEFT JOIN cm ON number = o_orderkey
WHERE o_orderkey % 10 <> 0 AND o_orderdate >= TIMESTAMP '1997-01-01'""")
def src_code_issues(t: Tables):
    docs = S.issues(issues(t), comments(t), "h1", since="1997-01-01T00:00:00Z", seq=F.col("o_orderkey"))
    f = lambda p: F.get_json_object(F.col("content").cast("string"), p)
    return docs.select(
        F.col("seq").alias("number"), "id", "source_ref.version", F.array_join("tags", "|").alias("tags"),
        f("$.title").alias("title"), f("$.body").alias("body"), f("$.milestone").alias("milestone"),
        F.json_array_length(f("$.comments")).cast("bigint").alias("n_comments"))


@query("flt_issue_not_pull", "SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0")
def flt_issue_not_pull(t: Tables):
    return issues(t).where(issue_not_pull(F.col("p.pull_request"))).select("o_orderkey")


# ---------------------------------------------------------------------- pulls


def pulls(t: Tables):
    k = F.col("o_orderkey")
    payload = F.to_json(F.struct(
        k.alias("number"), F.concat(F.lit("PR "), k).alias("title"), F.col("o_orderpriority").alias("body"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
        F.concat(F.lit("https://github.com/o/r/pull/"), k).alias("html_url"),
        F.col("_day").alias("created_at"), F.col("_day").alias("updated_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("_day")).alias("merged_at"),
        (k % 6 == 0).alias("draft"), login(F.concat(F.lit("u"), "o_custkey")).alias("user"),
        F.array(login(F.lit("rev"))).alias("requested_reviewers"),
        F.struct(F.lit("main").alias("ref")).alias("base"),
        F.struct(F.concat(F.lit("b"), k).alias("ref"), F.md5(k.cast("string")).alias("sha")).alias("head")))
    return landed(_dated(t.orders, "o_orderdate").select(k, F.lit("o/r").alias("repo"),
                                  F.concat(F.lit("diff "), k).alias("diff"), payload.alias("payload")), S.PULL)


def reviews(t: Tables):
    l = _dated(t.lineitem.where("l_returnflag = 'R'"), "l_shipdate")
    payload = F.to_json(F.struct(
        login(F.concat(F.lit("s"), "l_suppkey")).alias("user"), F.lit("APPROVED").alias("state"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("body"),
        F.col("_day").alias("submitted_at")))
    return (landed(l.select(F.lit("o/r").alias("repo"), F.col("l_orderkey").alias("number"),
                            payload.alias("payload")), S.REVIEW).withColumnRenamed("p", "r").drop("payload"))


def _nested_sql(name: str, flag: str) -> str:
    return f"""{name} AS (SELECT l_orderkey AS number, count(*) AS n,
  string_agg({BODY_SQL}, ',' ORDER BY l_shipdate, {BODY_SQL}) AS bodies FROM lineitem
  WHERE l_returnflag {flag} GROUP BY 1)"""


PULLS_SQL = f"{_nested_sql('rv', chr(61) + chr(32) + repr('R'))}, {_nested_sql('cc', '<> ' + repr('R'))}"


@query("jn_pull_reviews", f"""WITH {PULLS_SQL} SELECT o_orderkey AS number, coalesce(rv.n, 0) AS n_reviews,
  coalesce(cc.n, 0) AS n_comments, coalesce(rv.bodies, '') AS reviews, coalesce(cc.bodies, '') AS comments
FROM orders LEFT JOIN rv ON rv.number = o_orderkey LEFT JOIN cc ON cc.number = o_orderkey
WHERE o_orderkey % 6 <> 0""")
def jn_pull_reviews(t: Tables):
    return S.pulls_with_reviews(pulls(t), reviews(t), comments(t, "l_returnflag <> 'R'")).select(
        "number", F.col("reviews_count").alias("n_reviews"), F.col("comments_count").alias("n_comments"),
        bodies("reviews").alias("reviews"), bodies("comments").alias("comments"))


STATE_SQL = "CASE o_orderstatus WHEN 'F' THEN 'merged' WHEN 'O' THEN 'open' ELSE 'closed' END"


@query("src_code_pulls", f"""WITH {PULLS_SQL} SELECT o_orderkey AS number,
  sha256('h1:https://github.com/o/r/pull/' || o_orderkey) AS id,
  'pull_request|repo:o/r|state:' || {STATE_SQL} AS tags, {STATE_SQL} AS state,
  CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS merged, 'diff ' || o_orderkey AS diff,
  md5(o_orderkey::VARCHAR) AS head_sha, coalesce(rv.n, 0) AS n_reviews, coalesce(cc.n, 0) AS n_comments
FROM orders LEFT JOIN rv ON rv.number = o_orderkey LEFT JOIN cc ON cc.number = o_orderkey
WHERE o_orderkey % 6 <> 0 AND o_orderdate >= TIMESTAMP '1997-01-01'""")
def src_code_pulls(t: Tables):
    docs = S.pulls(pulls(t), reviews(t), comments(t, "l_returnflag <> 'R'"), "h1",
                   since="1997-01-01T00:00:00Z", seq=F.col("o_orderkey"))
    f = lambda p: F.get_json_object(F.col("content").cast("string"), p)
    n = lambda p: F.json_array_length(f(p)).cast("bigint")
    return docs.select(
        F.col("seq").alias("number"), "id", F.array_join("tags", "|").alias("tags"), f("$.state").alias("state"),
        f("$.merged").alias("merged"), f("$.diff").alias("diff"), f("$.head_sha").alias("head_sha"),
        n("$.reviews").alias("n_reviews"), n("$.comments").alias("n_comments"))


@query("flt_pull_drafts", """SELECT o_orderkey FROM orders WHERE o_orderkey % 6 <> 0
  AND o_orderdate >= TIMESTAMP '1999-01-01'""")
def flt_pull_drafts(t: Tables):
    keep = pull_wanted(F.col("p.draft"), F.col("p.updated_at"), since="1999-01-01T00:00:00Z")
    return pulls(t).where(keep).select("o_orderkey")


@query("fn_pr_state", f"SELECT o_orderkey, {STATE_SQL} AS state FROM orders")
def fn_pr_state(t: Tables):
    return pulls(t).select("o_orderkey", pull_state(F.col("p.state"), F.col("p.merged_at")).alias("state"))


# ----------------------------------- releases, commits, repositories, threads


def releases(t: Tables):
    k = F.col("p_partkey")
    asset = lambda n: F.struct(F.concat(F.lit(n), k).alias("name"), F.col("p_size").alias("size"),
                               F.concat(F.lit("https://d.test/"), k, F.lit(f"/{n}")).alias("browser_download_url"))
    payload = F.to_json(F.struct(
        k.alias("id"), F.concat(F.lit("v"), k).alias("tag_name"), F.col("p_name").alias("name"),
        F.col("p_type").alias("body"), F.concat(F.lit("https://github.com/o/r/releases/"), k).alias("html_url"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"), (F.col("p_size") < 10).alias("prerelease"),
        login(F.col("p_brand")).alias("author"),
        F.when(F.col("p_size") % 2 == 0, F.array(asset("a"), asset("b"))).alias("assets")))
    return landed(t.part.select(k, F.lit("o/r").alias("repo"), payload.alias("payload")), S.RELEASE)


@query("src_code_releases", """SELECT sha256('h1:https://github.com/o/r/releases/' || p_partkey) AS id,
  p_partkey::VARCHAR AS version, 'sequence' AS cursor_type, 'release|repo:o/r|v' || p_partkey AS tags,
  p_name AS name, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 0 END AS n_assets,
  CASE WHEN p_size % 2 = 0 THEN 'https://d.test/' || p_partkey || '/b' END AS second_url
FROM part WHERE p_size >= 10 AND p_partkey > 100""")
def src_code_releases(t: Tables):
    docs = S.releases(releases(t), "h1", since_id=100, include_prereleases=False, seq=F.col("p_partkey"))
    f = lambda p: F.get_json_object(F.col("content").cast("string"), p)
    return docs.select("id", "source_ref.version", F.col("cursor.source_type").alias("cursor_type"),
                       F.array_join("tags", "|").alias("tags"), f("$.name").alias("name"),
                       F.json_array_length(f("$.assets")).alias("n_assets"),
                       f("$.assets[1].download_url").alias("second_url"))


@query("flt_release_pre", "SELECT p_partkey FROM part WHERE p_size >= 10 AND p_partkey > 100")
def flt_release_pre(t: Tables):
    keep = release_wanted(F.col("p.prerelease"), F.col("p.id"), False, 100)
    return releases(t).where(keep).select("p_partkey")


def commits(t: Tables):
    k = F.col("c_custkey")
    person = lambda name, date: F.struct(name.alias("name"), F.concat(name, F.lit("@x.test")).alias("email"),
                                         date.alias("date"))
    files = F.transform(F.sequence(F.lit(1), (k % 80 + 1).cast("int")), lambda i: F.struct(
        F.concat(F.lit("f"), i).alias("filename"), F.lit("modified").alias("status"), i.alias("additions"),
        F.lit(0).alias("deletions"), F.lit("@@").alias("patch")))
    payload = F.to_json(F.struct(
        F.md5(k.cast("string")).alias("sha"), F.concat(F.lit("https://github.com/o/r/commit/"), k).alias("html_url"),
        F.struct(F.col("c_name").alias("message"),
                 person(F.col("c_name"), F.when(k % 5 != 0, iso(D.at(k), "Z"))).alias("author"),
                 person(F.lit("bot"), iso(D.at(k + 60), "Z")).alias("committer")).alias("commit"),
        F.array(F.struct(F.md5((k - 1).cast("string")).alias("sha"))).alias("parents"),
        F.struct((k % 80 + 1).alias("additions"), F.lit(0).alias("deletions"), (k % 80 + 1).alias("total"))
        .alias("stats"), files.alias("files")))
    return landed(spread(t.customer).select(k, F.lit("o/r").alias("repo"), payload.alias("payload")), S.COMMIT)


@query("src_code_commits", """SELECT sha256('h1:https://github.com/o/r/commit/' || c_custkey) AS id,
  md5(c_custkey::VARCHAR) AS version, strftime(TIMESTAMP '2024-01-01' + to_seconds(
    c_custkey + CASE WHEN c_custkey % 5 = 0 THEN 60 ELSE 0 END), '%Y-%m-%dT%H:%M:%SZ') AS cursor_value,
  c_name AS message, (c_custkey % 80 + 1)::INT AS n_files, md5((c_custkey - 1)::VARCHAR) AS parent,
  (c_custkey % 80 + 1)::VARCHAR AS total FROM customer""")
def src_code_commits(t: Tables):
    docs = S.commits(commits(t), "h1", seq=F.col("c_custkey"))
    f = lambda p: F.get_json_object(F.col("content").cast("string"), p)
    return docs.select("id", "source_ref.version", F.col("cursor.value").alias("cursor_value"),
                       f("$.message").alias("message"), F.json_array_length(f("$.files_changed")).alias("n_files"),
                       f("$.parents[0]").alias("parent"), f("$.stats.total").alias("total"))


@query("src_code_repos", """SELECT sha256('h1:https://github.com/o/' || source || '-' || lang) AS id,
  'o/' || source || '-' || lang AS full_name, lang AS language, count(*)::VARCHAR AS stars, 'main' AS branch
FROM documents GROUP BY source, lang""")
def src_code_repos(t: Tables):
    name = F.concat(F.lit("o/"), F.concat_ws("-", "source", "lang"))
    rows = t.documents.groupBy("source", "lang").agg(F.count("*").alias("n"))
    payload = F.to_json(F.struct(
        name.alias("full_name"), F.col("lang").alias("language"), F.col("n").alias("stargazers_count"),
        F.concat(F.lit("https://github.com/"), name).alias("html_url"),
        F.array(F.lit("x")).alias("topics")))
    docs = S.repos(landed(rows.select(payload.alias("payload")), S.REPO), "h1")
    f = lambda p: F.get_json_object(F.col("content").cast("string"), p)
    return docs.select("id", f("$.full_name").alias("full_name"), f("$.language").alias("language"),
                       f("$.stars").alias("stars"), f("$.default_branch").alias("branch"))


@query("src_code_discussions", """SELECT sha256('h1:https://github.com/o/r/discussions/' || conv_id) AS id,
  'T' || count(*) AS version, 'discussion|repo:o/r' AS tags, count(*)::VARCHAR AS n FROM conversations GROUP BY conv_id""")
def src_code_discussions(t: Tables):
    rows = t.conversations.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        F.lit("o/r").alias("repo"), F.to_json(F.struct(
            F.concat(F.lit("https://github.com/o/r/discussions/"), "conv_id").alias("url"),
            F.concat(F.lit("T"), "n").alias("updatedAt"), "n")).alias("payload"))
    docs = S.discussions(rows, "h1")
    return docs.select("id", "source_ref.version", F.array_join("tags", "|").alias("tags"),
                       F.get_json_object(F.col("content").cast("string"), "$.n").alias("n"))
