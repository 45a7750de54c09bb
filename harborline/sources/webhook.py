"""Pushed deliveries: verify, type, decide, list what they touch.  Every
function works on a batch and on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.functions.codec import body_signature_valid, lower_keys
from harborline.functions.names import branch_of_ref
from harborline.operators.filters import delivery_acquires
from harborline.session import once
from harborline.sources.common import text_or

COMMITS = "array<struct<added:array<string>,modified:array<string>,removed:array<string>>>"
ENVELOPE = ("action string, repository struct<full_name:string>, sender struct<login:string>")
_NO_FILES = "array<string>"


def events(deliveries: DataFrame, secret: str | None = None) -> DataFrame:
    """Deliveries (body text, headers map, ...) -> typed events.  Deliveries
    whose signature does not hold or whose body is not JSON are left out."""
    body = F.col("body")
    rows = deliveries.withColumn("h", lower_keys(F.col("headers")))
    h = lambda name: F.try_element_at("h", F.lit(name))
    signed = body_signature_valid(secret, F.encode(body, "UTF-8"), h("x-hub-signature-256"))
    read = F.from_json(F.when(signed, body), ENVELOPE, {"mode": "PERMISSIVE"})
    valid = F.when(signed & F.try_parse_json(body).isNotNull(), read)
    p = F.col("p")
    return once(rows, "p", valid).where(p.isNotNull()).select(
        *[c for c in deliveries.columns if c != "headers"],
        text_or(h("x-github-event")).alias("event_type"), p["action"].alias("action"),
        # A delivery without an id is known by its body: distinct ones stay apart.
        F.when(F.length(F.trim(h("x-github-delivery"))) > 0, h("x-github-delivery")).otherwise(
            F.concat(F.lit("sha256:"), F.sha2(F.encode(body, "UTF-8"), 256))).alias("delivery_id"),
        text_or(p["repository"]["full_name"]).alias("repo"),
        text_or(p["sender"]["login"]).alias("sender"))


def acquiring(rows: DataFrame) -> DataFrame:
    return rows.where(delivery_acquires(F.col("event_type"), F.col("action")))


def _commits() -> Column:
    return F.coalesce(F.from_json(F.get_json_object("body", "$.commits"), COMMITS),
                      F.array().cast(COMMITS))


def _list(c: Column) -> Column:
    return F.coalesce(c, F.array().cast(_NO_FILES))


def ref_info(rows: DataFrame) -> DataFrame:
    ref = text_or(F.get_json_object("body", "$.ref"), "refs/heads/main")
    return (rows.where(F.col("event_type") == "push").withColumn("ref", ref)
            .withColumn("branch", branch_of_ref(F.col("ref"))))


def affected_resources(rows: DataFrame) -> DataFrame:
    """One row per resource an event touches, in payload order."""
    branch = branch_of_ref(F.get_json_object("body", "$.ref"))
    prefix = F.concat(F.lit("https://github.com/"), F.col("repo"), F.lit("/blob/"), branch,
                      F.lit("/"))
    pushed = F.flatten(F.transform(_commits(), lambda c: F.transform(
        F.concat(_list(c["added"]), _list(c["modified"])), lambda f: F.concat(prefix, f))))
    url = lambda kind: F.array(F.get_json_object("body", f"$.{kind}.html_url"))
    kind = F.col("event_type")
    found = (F.when(kind == "push", pushed).when(kind == "issues", url("issue"))
             .when(kind == "pull_request", url("pull_request"))
             .when(kind == "release", url("release")))
    kept = F.filter(found, lambda r: F.length(r) > 0)
    return rows.select(*[c for c in rows.columns if c != "body"],
                       F.posexplode(kept).alias("pos", "resource"))


def push_file_status(rows: DataFrame) -> DataFrame:
    """Final status per file of a push: later commits win, and inside a commit
    removed beats modified beats added.  Resolved inside the delivery's row
    (map keys, last wins): no window, no shuffle."""
    mark = lambda files, status: F.transform(
        _list(files), lambda f: F.struct(f.alias("path"), F.lit(status).alias("status")))
    steps = F.flatten(F.transform(_commits(), lambda c: F.concat(
        mark(c["added"], "added"), mark(c["modified"], "modified"), mark(c["removed"], "removed"))))
    return (rows.where(F.col("event_type") == "push")
            .select(*[c for c in rows.columns if c != "body"],
                    F.explode(F.map_from_entries(steps)).alias("path", "status")))
