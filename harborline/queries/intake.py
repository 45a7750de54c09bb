"""Pushed deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions.codec import body_signature_valid, hmac_sha256
from harborline.functions.names import branch_of_ref
from harborline.operators.filters import delivery_acquires, unknown_event_types
from harborline.queries.chat_mail import hmac_sql
from harborline.queries.registry import Tables, query
from harborline.session import once
from harborline.sources import webhook

SECRET = "hook-secret"
KINDS = ("push", "issues", "pull_request", "release", "star", "deployment", "push", "repository")
ACTIONS = ("opened", "published", "labeled")


def pick(items, n):
    return F.element_at(F.array(*map(F.lit, items)), (n % len(items) + 1).cast("int"))


def deliveries(t: Tables, rows=None):
    """One delivery per event; every seventh is badly signed, every eleventh
    is sent twice, every thirteenth has no readable body."""
    e = t.events if rows is None else rows
    k = F.col("event_id")
    kind, action = pick(KINDS, k), pick(ACTIONS, F.floor(k / 8))
    repo = F.concat(F.lit("o/r"), F.col("user_id") % 20)
    name = lambda n, m: F.concat(F.lit(n), F.col("user_id") % m, F.lit(".py"))
    commit = lambda a, m, r: F.struct(a.alias("added"), m.alias("modified"), r.alias("removed"))
    none = F.array().cast("array<string>")
    push = F.to_json(F.struct(
        F.struct(repo.alias("full_name")).alias("repository"),
        F.when(k % 2 == 0, F.concat(F.lit("refs/heads/b"), F.col("user_id") % 3)).alias("ref"),
        F.struct(F.concat(F.lit("u"), "user_id").alias("login")).alias("sender"),
        F.array(commit(F.array(name("a", 5), F.lit("new.py")), none, none),
                commit(none, F.array(name("a", 4)), F.array(F.lit("new.py"))),
                commit(F.array(F.lit("z.py")), none, F.array(name("a", 3)))).alias("commits")))
    url = lambda path: F.struct(F.concat(F.lit("https://github.com/"), repo, F.lit(f"/{path}/"), k).alias("html_url"))
    other = F.to_json(F.struct(
        F.struct(repo.alias("full_name")).alias("repository"), action.alias("action"),
        F.struct(F.concat(F.lit("u"), "user_id").alias("login")).alias("sender"),
        url("issues").alias("issue"), url("pull").alias("pull_request"), url("releases").alias("release")))
    body = F.when(k % 13 == 0, F.lit("oops {")).when(kind == "push", push).otherwise(other)
    sent = F.when(k % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = once(e, "body", body)
    signed = F.concat(F.lit("sha256="), hmac_sha256(SECRET, F.encode("body", "UTF-8")))
    headers = F.create_map(
        F.lit("X-GitHub-Event"), kind, F.lit("x-github-DELIVERY"), F.concat(F.lit("d"), k),
        F.lit("X-Hub-Signature-256"), F.when(k % 7 == 0, F.lit("sha256=00")).otherwise(signed))
    rows = rows.select(k, "user_id", F.col("ts").cast("timestamp").alias("received_at"),
                       "body", headers.alias("headers"), sent.alias("sent"))
    return rows.withColumn("copy", F.explode("sent")).drop("sent")


HOOK_SQL = f"""hk AS (SELECT event_id, user_id, ts, ({list(KINDS)})[(event_id % 8)::INT + 1] AS event_type,
  'o/r' || (user_id % 20) AS repo, 'u' || user_id AS sender, 'd' || event_id AS delivery_id,
  CASE WHEN event_id % 8 NOT IN (0, 6) THEN ({list(ACTIONS)})[(event_id // 8 % 3)::INT + 1] END AS action,
  CASE WHEN event_id % 2 = 0 THEN 'b' || (user_id % 3) ELSE 'main' END AS branch,
  CASE WHEN event_id % 11 = 0 THEN 2 ELSE 1 END AS copies
  FROM events WHERE event_id % 7 <> 0 AND event_id % 13 <> 0),
ev AS (SELECT * FROM hk, range(2) c(copy) WHERE copy < copies)"""
ACQUIRE_SQL = """(event_type = 'push' OR (event_type = 'issues' AND action = 'opened')
  OR (event_type = 'pull_request' AND action = 'opened') OR (event_type = 'release' AND action = 'published'))"""


@query("src_webhook_events", f"""WITH {HOOK_SQL} SELECT event_id, copy::INT AS copy, event_type, action, delivery_id,
  repo, sender FROM ev""")
def src_webhook_events(t: Tables):
    return webhook.events(deliveries(t), SECRET).select(
        "event_id", "copy", "event_type", "action", "delivery_id", "repo", "sender")


@query("flt_webhook_acquire", f"WITH {HOOK_SQL} SELECT event_id, copy::INT AS copy FROM ev WHERE {ACQUIRE_SQL}")
def flt_webhook_acquire(t: Tables):
    rows = webhook.events(deliveries(t), SECRET)
    return rows.where(delivery_acquires(F.col("event_type"), F.col("action"))).select("event_id", "copy")


@query("flt_webhook_unknown_types", f"""WITH {HOOK_SQL} SELECT event_type, count(*) AS deliveries FROM ev
WHERE event_type = 'deployment' GROUP BY 1""")
def flt_webhook_unknown_types(t: Tables):
    return unknown_event_types(webhook.events(deliveries(t), SECRET))


@query("fn_hmac_sha256", f"""SELECT event_id, {hmac_sql(SECRET, 'props')} AS signature,
  event_id % 5 <> 0 AND event_id % 5 <> 1 AS valid FROM events""")
def fn_hmac_sha256(t: Tables):
    k, body = F.col("event_id"), F.encode("props", "UTF-8")
    good = hmac_sha256(SECRET, body)
    header = F.when(k % 5 == 0, good).when(k % 5 != 1, F.concat(F.lit("sha256="), good))
    return t.events.select(k, good.alias("signature"), body_signature_valid(SECRET, body, header).alias("valid"))


@query("fn_branch_from_ref", """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'main'
  WHEN event_id % 4 = 1 THEN event_type ELSE 'u' || user_id END AS branch FROM events""")
def fn_branch_from_ref(t: Tables):
    k = F.col("event_id")
    ref = (F.when(k % 4 == 1, F.concat(F.lit("refs/tags/"), "event_type"))
           .when(k % 4 == 2, F.concat(F.lit("refs/heads/x/u"), "user_id"))
           .when(k % 4 == 3, F.concat(F.lit("u"), "user_id")))
    return t.events.select(k, branch_of_ref(ref).alias("branch"))


@query("fn_push_resources", f"""WITH {HOOK_SQL}, p AS (
  SELECT event_id, copy, n AS pos, 'https://github.com/' || repo || '/blob/' || branch || '/' || f AS resource
  FROM ev, (VALUES (0), (1), (2), (3)) v(n),
    LATERAL (SELECT CASE n WHEN 0 THEN 'a' || (user_id % 5) || '.py' WHEN 1 THEN 'new.py'
      WHEN 2 THEN 'a' || (user_id % 4) || '.py' ELSE 'z.py' END AS f) WHERE event_type = 'push'
  UNION ALL SELECT event_id, copy, 0, 'https://github.com/' || repo || '/' || CASE event_type
    WHEN 'issues' THEN 'issues' WHEN 'pull_request' THEN 'pull' ELSE 'releases' END || '/' || event_id
  FROM ev WHERE event_type IN ('issues', 'pull_request', 'release'))
SELECT event_id, copy::INT AS copy, pos, resource FROM p""")
def fn_push_resources(t: Tables):
    return webhook.affected_resources(webhook.events(deliveries(t), SECRET)).select(
        "event_id", "copy", "pos", "resource")


@query("win_push_file_status", f"""WITH {HOOK_SQL}, s AS (
  SELECT event_id, copy, n, CASE n WHEN 0 THEN 'a' || (user_id % 5) || '.py' WHEN 1 THEN 'new.py'
      WHEN 2 THEN 'a' || (user_id % 4) || '.py' WHEN 3 THEN 'new.py' WHEN 4 THEN 'z.py'
      ELSE 'a' || (user_id % 3) || '.py' END AS path,
    CASE WHEN n IN (0, 1, 4) THEN 'added' WHEN n = 2 THEN 'modified' ELSE 'removed' END AS status
  FROM ev, (VALUES (0), (1), (2), (3), (4), (5)) v(n) WHERE event_type = 'push')
SELECT event_id, copy::INT AS copy, path, status FROM s
QUALIFY row_number() OVER (PARTITION BY event_id, copy, path ORDER BY n DESC) = 1""")
def win_push_file_status(t: Tables):
    return webhook.push_file_status(webhook.events(deliveries(t), SECRET)).select(
        "event_id", "copy", "path", "status")


@query("ext_source", f"""WITH {HOOK_SQL} SELECT sha256('x1:hook://' || delivery_id) AS id, delivery_id AS version,
  event_type AS f_kind FROM hk WHERE event_id > 5000 AND {ACQUIRE_SQL}""")
def ext_source(t: Tables):
    """A source of the user's own: deliveries as documents, after a position."""
    from harborline.operators.cursors import delta
    from harborline.operators.envelope import envelope
    from harborline.sources.common import SourceRegistry, json_doc

    def hook_source(landed, cursors, instance_id):
        events = webhook.acquiring(webhook.events(landed.where("copy = 0"), SECRET))
        stored = cursors.select("instance_id", F.col("value").alias("since"))
        placed = events.withColumn("instance_id", F.lit(instance_id)).join(stored, "instance_id", "left")
        kept = placed.where(delta(F.col("event_id").cast("string"), F.col("since"), op=">", kind="bigint"))
        return envelope(kept, connector_id="hook", instance_id=F.lit(instance_id),
                        uri=F.concat(F.lit("hook://"), "delivery_id"), version=F.col("delivery_id"),
                        content=json_doc(kind=F.col("event_type")), content_type="application/json",
                        seq=F.col("event_id"))

    registry = SourceRegistry()
    registry.register("hook", hook_source)
    cursors = t.spark.createDataFrame([("x1", "5000")], "instance_id string, value string")
    docs = registry.pull("hook", deliveries(t), cursors, instance_id="x1")
    return docs.select("id", "source_ref.version", F.get_json_object(
        F.col("content").cast("string"), "$.kind").alias("f_kind"))
