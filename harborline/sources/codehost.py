"""Code host: files, issues, pull requests, releases, commits, repositories,
discussions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.catalog import values as V
from harborline.functions.classify import pull_state
from harborline.functions.names import matches_any_glob, mime_by_extension
from harborline.operators.cursors import unchanged_snapshots
from harborline.operators.envelope import envelope
from harborline.operators.filters import (
    by_extension, by_size, issue_not_pull, pull_wanted, release_wanted, state_wanted,
)
from harborline.operators.joins import file_blobs, nest, withheld
from harborline.sources.common import json_doc, meta, tag, text_or

_LOGIN = "struct<login:string>"
ISSUE = (f"number bigint, title string, body string, state string, html_url string, "
         f"created_at string, updated_at string, closed_at string, comments bigint, user {_LOGIN}, "
         f"labels array<struct<name:string>>, assignees array<{_LOGIN}>, "
         "milestone struct<title:string>, pull_request struct<url:string>")
COMMENT = ("user struct<login:string>, body string, path string, line bigint, "
           "created_at string, updated_at string")
REVIEW = "user struct<login:string>, state string, body string, submitted_at string"
PULL = (f"number bigint, title string, body string, state string, html_url string, "
        f"created_at string, updated_at string, merged_at string, draft boolean, user {_LOGIN}, "
        f"labels array<struct<name:string>>, requested_reviewers array<{_LOGIN}>, "
        "base struct<ref:string>, head struct<ref:string,sha:string>")
RELEASE = (f"id bigint, tag_name string, name string, body string, html_url string, "
           f"created_at string, published_at string, prerelease boolean, draft boolean, "
           f"author {_LOGIN}, "
           "assets array<struct<name:string,size:bigint,browser_download_url:string>>")
_PERSON = "struct<name:string,email:string,date:string>"
COMMIT = (f"sha string, html_url string, commit struct<message:string,author:{_PERSON},"
          f"committer:{_PERSON}>, parents array<struct<sha:string>>, "
          "stats struct<additions:bigint,deletions:bigint,total:bigint>, "
          "files array<struct<filename:string,status:string,additions:bigint,deletions:bigint,"
          "patch:string>>")
REPO = ("full_name string, default_branch string, private boolean, description string, "
        "language string, topics array<string>, stargazers_count bigint, html_url string")


def _seq(seq: Column | None) -> Column:
    return seq if seq is not None else F.monotonically_increasing_id()


def _names(items: Column, field: str) -> Column:
    return F.coalesce(F.transform(items, lambda x: x[field]), F.array().cast("array<string>"))


def wanted_files(tree: DataFrame, patterns=(), max_bytes: int = V.MAX_CODE_FILE_BYTES,
                 stored_trees: DataFrame | None = None) -> DataFrame:
    """Tree entries (repo, branch, tree_sha, path, type, sha, size) to fetch;
    repositories whose tree is unchanged are left out first."""
    rows = unchanged_snapshots(tree, stored_trees) if stored_trees is not None else tree
    keep = ((F.col("type") == "blob")
            & by_extension(F.col("path"), V.CODE_EXCLUDED_EXTENSIONS)
            & by_size(F.col("size"), max_bytes, drop_empty=False))
    if patterns:
        keep = keep & matches_any_glob(F.col("path"), patterns)
    return rows.where(keep)


def decoded(blobs: DataFrame) -> DataFrame:
    """Blobs (sha, encoding, content text) -> binary content; blobs in an
    unknown encoding are left out."""
    text = F.col("content")
    raw = (F.when(F.coalesce("encoding", F.lit("base64")) == "base64",
                  F.unbase64(F.replace(text, F.lit("\n"), F.lit(""))))
           .when(F.col("encoding") == "utf-8", F.encode(text, "UTF-8")))
    return blobs.select("sha", raw.alias("content")).where("content is not null")


def files(entries: DataFrame, blobs: DataFrame, instance_id: str,
          seq: Column | None = None) -> DataFrame:
    """Wanted tree entries + blobs -> file documents; the stored position is
    the tree's sha."""
    col = F.col
    rows = file_blobs(entries, decoded(blobs))
    url = F.concat(F.lit("https://github.com/"), col("repo"), F.lit("/blob/"), col("branch"),
                   F.lit("/"), col("path"))
    return envelope(
        rows, connector_id="github", instance_id=F.lit(instance_id), uri=url,
        content=col("content"), content_type=mime_by_extension(col("path")), seq=_seq(seq),
        version=col("sha"), cursor_value=col("tree_sha"), cursor_type="token",
        tags=["file", tag("repo:", col("repo")), tag("branch:", col("branch"))],
        metadata=meta(resource_type=F.lit("file"), repo=col("repo"), branch=col("branch"),
                      path=col("path"), sha=col("sha"), size=col("size"),
                      tree_sha=col("tree_sha"), html_url=url))


def issues_with_comments(rows: DataFrame, comments: DataFrame, since: str | None = None,
                         include_closed: bool = True) -> DataFrame:
    """Issues (repo, `p`) with their comments (repo, number, `c`) nested."""
    p = F.col("p")
    kept = rows.where(issue_not_pull(p["pull_request"]) & state_wanted(p["state"], include_closed))
    if since:
        kept = kept.where(p["updated_at"] >= since)
    c = F.col("c")
    item = F.struct(text_or(c["user"]["login"]).alias("author"), text_or(c["body"]).alias("body"),
                    text_or(c["created_at"]).alias("created_at"),
                    text_or(c["updated_at"]).alias("updated_at"))
    packed = comments.select("repo", "number", c["created_at"].alias("_at"),
                             text_or(c["body"]).alias("_b"), item.alias("_v"))
    return nest(kept.withColumn("number", p["number"]), packed, ["repo", "number"], F.col("_v"),
                ["_at", "_b"], "comments")


def issues(rows: DataFrame, comments: DataFrame, instance_id: str, since: str | None = None,
           include_closed: bool = True, seq: Column | None = None) -> DataFrame:
    p, col = F.col("p"), F.col
    full = issues_with_comments(rows, comments, since, include_closed)
    labels = _names(p["labels"], "name")
    content = json_doc(
        number=p["number"], title=p["title"], body=text_or(p["body"]), state=p["state"],
        labels=labels, assignees=_names(p["assignees"], "login"), author=p["user"]["login"],
        created_at=p["created_at"], updated_at=p["updated_at"], closed_at=p["closed_at"],
        milestone=p["milestone"]["title"], comments=col("comments"))
    return envelope(
        full, connector_id="github", instance_id=F.lit(instance_id), uri=p["html_url"],
        content=content, content_type="application/json", seq=_seq(seq), version=p["updated_at"],
        cursor_value=p["updated_at"], withheld=withheld("comments"),
        tags=["issue", tag("repo:", col("repo")), tag("state:", p["state"])],
        metadata=meta(resource_type=F.lit("issue"), repo=col("repo"), number=p["number"],
                      state=p["state"], title=p["title"], labels=labels,
                      author=p["user"]["login"], updated_at=p["updated_at"]))


def pulls_with_reviews(rows: DataFrame, reviews: DataFrame, comments: DataFrame,
                       since: str | None = None, include_drafts: bool = False) -> DataFrame:
    """Pull requests (repo, `p`) with reviews (repo, number, `r`) and review
    comments (repo, number, `c`) nested; all three share one partitioning."""
    p, r, c = F.col("p"), F.col("r"), F.col("c")
    kept = (rows.where(pull_wanted(p["draft"], p["updated_at"], include_drafts, since))
            .withColumn("number", p["number"]))
    review = F.struct(text_or(r["user"]["login"]).alias("author"),
                      text_or(r["state"]).alias("state"), text_or(r["body"]).alias("body"),
                      text_or(r["submitted_at"]).alias("submitted_at"))
    remark = F.struct(text_or(c["user"]["login"]).alias("author"), text_or(c["body"]).alias("body"),
                      text_or(c["path"]).alias("path"), c["line"].alias("line"),
                      text_or(c["created_at"]).alias("created_at"))
    keys = ["repo", "number"]
    out = nest(kept, reviews.select(*keys, r["submitted_at"].alias("_at"),
                                    text_or(r["body"]).alias("_b"), review.alias("_v")),
               keys, F.col("_v"), ["_at", "_b"], "reviews")
    return nest(out, comments.select(*keys, c["created_at"].alias("_at"),
                                     text_or(c["body"]).alias("_b"), remark.alias("_v")),
                keys, F.col("_v"), ["_at", "_b"], "comments")


def pulls(rows: DataFrame, reviews: DataFrame, comments: DataFrame, instance_id: str,
          since: str | None = None, include_drafts: bool = False,
          seq: Column | None = None) -> DataFrame:
    """`rows` may carry the unified diff as text column `diff`."""
    p, col = F.col("p"), F.col
    full = pulls_with_reviews(rows, reviews, comments, since, include_drafts)
    state = pull_state(p["state"], p["merged_at"])
    diff = text_or(col("diff")) if "diff" in rows.columns else F.lit("")
    content = json_doc(
        number=p["number"], title=p["title"], body=text_or(p["body"]), state=state,
        base_branch=p["base"]["ref"], head_branch=p["head"]["ref"], head_sha=p["head"]["sha"],
        author=p["user"]["login"], labels=_names(p["labels"], "name"),
        reviewers=_names(p["requested_reviewers"], "login"),
        draft=F.coalesce(p["draft"], F.lit(False)), merged=p["merged_at"].isNotNull(),
        created_at=p["created_at"], updated_at=p["updated_at"], merged_at=p["merged_at"],
        reviews=col("reviews"), comments=col("comments"), diff=diff)
    return envelope(
        full, connector_id="github", instance_id=F.lit(instance_id), uri=p["html_url"],
        content=content, content_type="application/json", seq=_seq(seq), version=p["updated_at"],
        cursor_value=p["updated_at"], withheld=withheld("reviews", "comments"),
        tags=["pull_request", tag("repo:", col("repo")), tag("state:", state)],
        metadata=meta(resource_type=F.lit("pull_request"), repo=col("repo"), number=p["number"],
                      state=state, title=p["title"], author=p["user"]["login"],
                      merged=p["merged_at"].isNotNull(), head_sha=p["head"]["sha"],
                      updated_at=p["updated_at"]))


def releases(rows: DataFrame, instance_id: str, since_id: int | None = None,
             include_prereleases: bool = True, seq: Column | None = None) -> DataFrame:
    p, col = F.col("p"), F.col
    kept = rows.where(release_wanted(p["prerelease"], p["id"], include_prereleases, since_id))
    assets = F.coalesce(F.transform(p["assets"], lambda a: F.struct(
        text_or(a["name"]).alias("name"), F.coalesce(a["size"], F.lit(0)).alias("size"),
        text_or(a["browser_download_url"]).alias("download_url"))),
        F.array().cast("array<struct<name:string,size:bigint,download_url:string>>"))
    flag = lambda c: F.coalesce(c, F.lit(False))
    content = json_doc(
        id=p["id"], tag_name=p["tag_name"], name=text_or(p["name"]), body=text_or(p["body"]),
        prerelease=flag(p["prerelease"]), draft=flag(p["draft"]), author=p["author"]["login"],
        created_at=p["created_at"], published_at=p["published_at"], assets=assets)
    number = p["id"].cast("string")
    return envelope(
        kept, connector_id="github", instance_id=F.lit(instance_id), uri=p["html_url"],
        content=content, content_type="application/json", seq=_seq(seq), version=number,
        cursor_value=number, cursor_type="sequence",
        tags=["release", tag("repo:", col("repo")), p["tag_name"]],
        metadata=meta(resource_type=F.lit("release"), repo=col("repo"), tag_name=p["tag_name"],
                      release_id=p["id"], prerelease=flag(p["prerelease"]),
                      published_at=p["published_at"]))


def commits(rows: DataFrame, instance_id: str, seq: Column | None = None,
            max_files: int | None = None) -> DataFrame:
    """Commits with all their files, or the first `max_files` of them."""
    p, col = F.col("p"), F.col
    zero = lambda c: F.coalesce(c, F.lit(0))
    author, committer = p["commit"]["author"], p["commit"]["committer"]
    files = F.coalesce(p["files"], F.array())
    changed = F.transform(
        files if max_files is None else F.slice(files, 1, max_files), lambda f: F.struct(
            text_or(f["filename"]).alias("filename"), text_or(f["status"]).alias("status"),
            zero(f["additions"]).alias("additions"), zero(f["deletions"]).alias("deletions"),
            text_or(f["patch"]).alias("patch")))
    content = json_doc(
        sha=p["sha"], message=text_or(p["commit"]["message"]),
        author=F.struct(text_or(author["name"]).alias("name"),
                        text_or(author["email"]).alias("email"),
                        text_or(author["date"]).alias("date")),
        committer=F.struct(text_or(committer["name"]).alias("name"),
                           text_or(committer["date"]).alias("date")),
        parents=_names(p["parents"], "sha"),
        stats=F.struct(zero(p["stats"]["additions"]).alias("additions"),
                       zero(p["stats"]["deletions"]).alias("deletions"),
                       zero(p["stats"]["total"]).alias("total")),
        files_changed=changed)
    when = F.coalesce(F.nullif(author["date"], F.lit("")), committer["date"])
    return envelope(
        rows, connector_id="github", instance_id=F.lit(instance_id), uri=text_or(p["html_url"]),
        content=content, content_type="application/json", seq=_seq(seq), version=p["sha"],
        cursor_value=when, tags=["commit", tag("repo:", col("repo"))],
        metadata=meta(resource_type=F.lit("commit"), repo=col("repo"), sha=p["sha"],
                      author=text_or(author["name"]), date=text_or(author["date"]),
                      stats_total=zero(p["stats"]["total"])))


def repos(rows: DataFrame, instance_id: str, seq: Column | None = None) -> DataFrame:
    p = F.col("p")
    stars = F.coalesce(p["stargazers_count"], F.lit(0))
    content = json_doc(
        full_name=p["full_name"], description=text_or(p["description"]), language=p["language"],
        topics=F.coalesce(p["topics"], F.array().cast("array<string>")), stars=stars,
        private=F.coalesce(p["private"], F.lit(False)),
        default_branch=text_or(p["default_branch"], "main"), url=text_or(p["html_url"]))
    return envelope(
        rows, connector_id="github", instance_id=F.lit(instance_id), uri=text_or(p["html_url"]),
        content=content, content_type="application/json", seq=_seq(seq),
        metadata=meta(resource_type=F.lit("repository"), repo=p["full_name"],
                      language=p["language"], stars=stars))


def discussions(rows: DataFrame, instance_id: str, seq: Column | None = None) -> DataFrame:
    """Discussions (repo, payload JSON text) -> documents, stored verbatim."""
    field = lambda n: F.get_json_object("payload", f"$.{n}")
    return envelope(
        rows, connector_id="github", instance_id=F.lit(instance_id), uri=text_or(field("url")),
        content=F.col("payload"), content_type="application/json", seq=_seq(seq),
        version=field("updatedAt"), cursor_value=field("updatedAt"), cursor_type="token",
        tags=["discussion", tag("repo:", F.col("repo"))],
        metadata=meta(resource_type=F.lit("discussion"), repo=F.col("repo")))
