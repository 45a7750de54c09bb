"""Chat and mail, derived from conversations and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions.codec import base64_urlsafe_text, chat_signature_valid, header_map, hmac_sha256
from harborline.operators.filters import file_present, mail_labelled, member_active, message_wanted
from harborline.operators.joins import thread_replies
from harborline.queries.registry import Tables, query
from harborline.sources import chat, mail, mime
from harborline.sources.common import landed

# ----------------------------------------------------------------------- chat


def history(t: Tables):
    """One channel per conversation, one message per turn; turn 0 is the
    thread's parent.  Landed as JSON, parsed by the source's schema."""
    c = F.col
    ts = lambda turn: F.concat((F.lit(1704067200) + turn).cast("string"), F.lit(".000100"))
    system = c("role") == "system"
    # The reply count comes with the parent message, as the remote sends it.
    counts = t.conversations.groupBy("conv_id").agg(F.count("*").alias("n"))
    rows = t.conversations.join(counts, "conv_id")
    payload = F.to_json(F.struct(
        ts(c("turn")).alias("ts"), F.when(~system, c("role")).alias("user"),
        F.when(system, F.lit("B1")).alias("bot_id"), c("text"), F.lit("message").alias("type"),
        F.when((c("turn") == 1) & (c("conv_id") % 5 == 0), "channel_join").alias("subtype"),
        ts(F.lit(0)).alias("thread_ts"),
        F.when(c("turn") == 0, c("n") - 1).otherwise(0).alias("reply_count")))
    parsed = landed(rows.select("conv_id", "turn", F.concat(F.lit("C"), "conv_id").alias("channel_id"),
                                payload.alias("payload")), chat.MESSAGE)
    return parsed.select("conv_id", "turn", "channel_id", "p.*")


MSG_SQL = """m0 AS (SELECT conv_id, turn, 'C' || conv_id AS channel_id, role, text,
  (1704067200 + turn)::VARCHAR || '.000100' AS ts,
  count(*) OVER (PARTITION BY conv_id) - 1 AS others, turn = 1 AND conv_id % 5 = 0 AS joined
  FROM conversations),
m AS (SELECT *, role = 'system' AS bot, NOT (role = 'system') AND NOT joined AS wanted FROM m0),
rep AS (SELECT channel_id, count(*) AS n, string_agg(text, chr(31) ORDER BY ts) AS texts FROM m WHERE turn > 0 GROUP BY 1)"""


@query("src_slack_messages", f"""WITH {MSG_SQL} SELECT sha256('s1:slack://message/' || m.channel_id || '/' || ts) AS id,
  ts AS version, 'message|channel:' || m.channel_id AS tags, role AS f_user, text AS f_text,
  CASE WHEN turn = 0 THEN rep.n END AS f_replies, CASE WHEN turn = 0 AND others > 0 THEN 'true' ELSE 'false' END AS has_thread
FROM m LEFT JOIN rep ON rep.channel_id = m.channel_id WHERE wanted AND ts > '1704067200.000000'""")
def src_slack_messages(t: Tables):
    docs = chat.messages(history(t), "s1", oldest="1704067200.000000",
                         seq=F.col("conv_id") * 1_000_000 + F.col("turn"))
    body = F.col("content").cast("string")
    return docs.select(
        "id", "source_ref.version", F.array_join("tags", "|").alias("tags"),
        F.get_json_object(body, "$.user").alias("f_user"), F.get_json_object(body, "$.text").alias("f_text"),
        F.json_array_length(F.get_json_object(body, "$.replies")).cast("bigint").alias("f_replies"),
        F.get_json_object("source_metadata", "$.has_thread").alias("has_thread"))


@query("flt_message_bots", f"WITH {MSG_SQL} SELECT conv_id, turn FROM m WHERE wanted")
def flt_message_bots(t: Tables):
    return history(t).where(message_wanted(F.col("bot_id"), F.col("subtype"))).select("conv_id", "turn")


@query("jn_thread_replies", f"""WITH {MSG_SQL} SELECT m.channel_id, ts, rep.n AS n_replies, texts
FROM m JOIN rep ON rep.channel_id = m.channel_id WHERE turn = 0 AND others > 0""")
def jn_thread_replies(t: Tables):
    return thread_replies(history(t)).select(
        "channel_id", "ts", F.size("replies").cast("bigint").alias("n_replies"),
        F.array_join(F.transform("replies", lambda r: r["text"]), "\x1f").alias("texts"))


@query("src_slack_files", """SELECT sha256('s1:slack://file/F' || doc_id || '/' || doc_id || CASE doc_id % 3
    WHEN 0 THEN '.md' WHEN 1 THEN '.pdf' ELSE '' END) AS id, sha256(text) AS checksum,
  CASE WHEN doc_id % 4 = 0 THEN 'text/plain' WHEN doc_id % 3 = 0 THEN 'text/markdown'
    WHEN doc_id % 3 = 1 THEN 'application/pdf' ELSE 'application/octet-stream' END AS content_type,
  (1000 + doc_id)::VARCHAR AS version FROM documents WHERE doc_id % 5 <> 0 AND 1000 + doc_id >= 1100""")
def src_slack_files(t: Tables):
    k = F.col("doc_id")
    fid = F.concat(F.lit("F"), k)
    files = t.documents.select(
        fid.alias("id"), F.concat(k, F.when(k % 3 == 0, ".md").when(k % 3 == 1, ".pdf").otherwise(""))
        .alias("name"), F.when(k % 4 == 0, "text/plain").otherwise("").alias("mimetype"),
        F.when(k % 5 == 0, "tombstone").otherwise("hosted").alias("mode"), (k + 1000).alias("timestamp"),
        F.lit("text").alias("filetype"), F.col("n_chars").alias("size"), F.lit("u1").alias("user"))
    blobs = t.documents.select(fid.alias("id"), F.encode("text", "UTF-8").alias("content"))
    docs = chat.files(files, blobs, "s1", since_ts=1100, seq=F.col("timestamp"))
    return docs.select("id", "checksum", "content_type", "source_ref.version")


@query("flt_file_tombstone", "SELECT doc_id FROM documents WHERE doc_id % 5 <> 0")
def flt_file_tombstone(t: Tables):
    mode = F.when(F.col("doc_id") % 5 == 0, "tombstone").when(F.col("doc_id") % 5 == 1, "hosted")
    return t.documents.where(file_present(mode)).select("doc_id")


@query("src_slack_channels", """SELECT sha256('s1:slack://channel/C' || conv_id) AS id, 'room-' || conv_id AS name,
  'channel' AS tags, count(*)::VARCHAR AS f_members FROM conversations GROUP BY conv_id""")
def src_slack_channels(t: Tables):
    rooms = t.conversations.groupBy("conv_id").agg(F.count("*").alias("num_members")).select(
        F.concat(F.lit("C"), "conv_id").alias("id"), F.concat(F.lit("room-"), "conv_id").alias("name"),
        "num_members")
    docs = chat.channels(rooms, "s1")
    return docs.select("id", F.get_json_object("source_metadata", "$.name").alias("name"),
                       F.array_join("tags", "|").alias("tags"),
                       F.get_json_object(F.col("content").cast("string"), "$.num_members").alias("f_members"))


def members(t: Tables):
    k = F.col("c_custkey")
    return t.customer.select(
        F.concat(F.lit("U"), k).alias("id"), F.col("c_name").alias("name"),
        F.col("c_name").alias("real_name"), F.concat(F.lit("u"), k, F.lit("@x.test")).alias("email"),
        F.when(k % 7 == 0, True).alias("deleted"), (k % 5 == 0).alias("is_bot"), (k * 10).alias("updated"))


@query("src_slack_users", """SELECT sha256('s1:slack://user/U' || c_custkey) AS id, (c_custkey * 10)::VARCHAR AS version,
  c_name AS name, 'u' || c_custkey || '@x.test' AS email FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0""")
def src_slack_users(t: Tables):
    m = lambda f: F.get_json_object("source_metadata", f"$.{f}").alias(f)
    return chat.users(members(t), "s1").select("id", "source_ref.version", m("name"), m("email"))


@query("flt_user_active", """SELECT 'U' || c_custkey AS id FROM customer
WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0""")
def flt_user_active(t: Tables):
    return members(t).where(member_active(F.col("deleted"), F.col("is_bot"))).select("id")


SECRET = "chat-signing-secret"


def hmac_sql(secret: str, message: str) -> str:
    """HMAC-SHA256 in SQL: key blocks as literals, two nested digests."""
    block = secret.encode().ljust(64, b"\0")
    pads = [bytes(b ^ x for b in block).hex() for x in (0x36, 0x5C)]
    return f"sha256(unhex('{pads[1]}') || unhex(sha256(unhex('{pads[0]}') || encode({message}))))"


@query("fn_slack_signature", f"""WITH e AS (SELECT event_id, props AS body, (1704067200 + event_id)::VARCHAR AS ts FROM events)
SELECT event_id, event_id % 4 IN (0, 1) AND event_id % 3 <> 0 AS valid,
  'v0=' || {hmac_sql(SECRET, "'v0:' || ts || ':' || body")} AS signature FROM e""")
def fn_slack_signature(t: Tables):
    """A third arrives too late; of the rest half is forged or unsigned."""
    k = F.col("event_id")
    ts = (F.lit(1704067200) + k).cast("string")
    good = F.concat(F.lit("v0="), hmac_sha256(SECRET, F.encode(
        F.concat(F.lit("v0:"), ts, F.lit(":"), "props"), "UTF-8")))
    sent = F.when(k % 4 == 2, F.concat(F.lit("v0="), F.sha2("props", 256))).when(k % 4 == 3, F.lit("")) \
        .otherwise(good)
    received = (F.lit(1704067200) + k + F.when(k % 3 == 0, 301).otherwise(300)).cast("double")
    valid = chat_signature_valid(SECRET, F.encode("props", "UTF-8"), ts, sent, received)
    return t.events.select(k, valid.alias("valid"), good.alias("signature"))


# ----------------------------------------------------------------------- mail


def urlsafe(text):
    """Text as unpadded URL-safe base64."""
    coded = F.regexp_replace(F.base64(F.encode(text, "UTF-8")), r"[\r\n=]+", "")
    return F.replace(F.replace(coded, F.lit("+"), F.lit("-")), F.lit("/"), F.lit("_"))


def mailbox(t: Tables):
    """One message per document: flat, multipart, or nested two levels deep;
    some with attachments, one attachment kind above the size limit."""
    k, s = F.col("doc_id"), lambda c: c.cast("string")
    b64 = urlsafe
    text = F.col("text")
    leaf = lambda mime, name, data, size: F.struct(
        F.lit(mime).alias("mimeType"), name.alias("filename"),
        F.struct(data.alias("data"), size.cast("bigint").alias("size")).alias("body"))
    plain = leaf("text/plain", F.lit(""), b64(text), F.length(text))
    html = leaf("text/html", F.lit(""), b64(F.concat(F.lit("<p>"), text, F.lit("</p>"))), F.length(text))
    file = leaf("application/pdf", F.concat(F.lit("f"), k, F.lit(".pdf")), F.lit(""), k)
    huge = leaf("text/plain", F.lit("huge.txt"), b64(F.lit("not the body")), F.lit(6_000_000))
    headers = F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in (
        ("From", F.concat(F.lit("a"), k, F.lit("@x.test"))), ("TO", F.lit("list@x.test")),
        ("X-Note", F.lit("first")), ("x-note", F.lit("second")))])
    with_subject = F.concat(F.array(F.struct(F.lit("Subject").alias("name"),
                                             F.concat(F.lit("S"), k).alias("value"))), headers)
    hdr = F.when(k % 4 == 0, headers).otherwise(with_subject)
    top = lambda mime, parts: F.struct(F.lit(mime).alias("mimeType"), F.lit("").alias("filename"),
                                       hdr.alias("headers"), parts.alias("parts"))
    flat = F.to_json(F.struct(F.lit("text/plain").alias("mimeType"), hdr.alias("headers"),
                              F.struct(b64(text).alias("data")).alias("body")))
    one = F.to_json(top("multipart/mixed", F.array(plain, html, file)))
    nested = F.struct(F.lit("multipart/alternative").alias("mimeType"), F.array(plain, html).alias("parts"))
    two = F.concat(
        F.expr("''"), F.lit('{"mimeType":"multipart/mixed","headers":'), F.to_json(hdr),
        F.lit(',"parts":['), F.to_json(huge), F.lit(","), F.to_json(nested), F.lit(","), F.to_json(file),
        F.lit("]}"))
    payload = F.when(k % 3 == 0, flat).when(k % 3 == 1, one).otherwise(two)
    labels = F.array_compact(F.array(F.lit("INBOX"), F.when(k % 2 == 0, "WORK"), F.when(k % 9 == 0, "SPAM")))
    whole = F.concat(F.lit('{"id":"m'), k, F.lit('","threadId":"t'), k % 50, F.lit('","snippet":"s","internalDate":"'),
                     F.lit(1704067200000) + k * 1000, F.lit('","labelIds":'), F.to_json(labels),
                     F.lit(',"payload":'), payload, F.lit("}"))
    return landed(t.documents.select(k, "text", whole.alias("payload")), mail.MESSAGE)


MAIL_SQL = """mb AS (SELECT doc_id, 'm' || doc_id AS id, text AS body, doc_id % 3 AS kind,
  CASE WHEN doc_id % 4 = 0 THEN '(no subject)' ELSE 'S' || doc_id END AS subject,
  'a' || doc_id || '@x.test' AS sender, 1704067200000 + doc_id * 1000 AS ms,
  doc_id % 2 = 0 AS work, doc_id % 9 = 0 AS spam FROM documents)"""


@query("src_mail_messages", f"""WITH {MAIL_SQL} SELECT sha256('g1:gmail://message/' || id) AS id, ms::VARCHAR AS version,
  'email|thread:t' || (doc_id % 50) AS tags, subject, sender, body AS body_text,
  CASE WHEN kind = 0 THEN '' ELSE '<p>' || body || '</p>' END AS body_html,
  CASE WHEN kind = 0 THEN NULL ELSE 'f' || doc_id || '.pdf' END AS file_name,
  CASE WHEN kind = 0 THEN 'false' ELSE 'true' END AS has_attachments FROM mb WHERE work AND ms > 1704067300000""")
def src_mail_messages(t: Tables):
    docs = mail.messages(mailbox(t), "g1", body_format="both", labels=["INBOX", "WORK", "SPAM"],
                         since_ms=1704067300000, seq=F.col("doc_id"))
    f = lambda p: F.get_json_object(F.col("content").cast("string"), p)
    return docs.select(
        "id", "source_ref.version", F.array_join("tags", "|").alias("tags"), f("$.subject").alias("subject"),
        f("$.from").alias("sender"), f("$.body_text").alias("body_text"), f("$.body_html").alias("body_html"),
        f("$.attachments[0].name").alias("file_name"),
        F.get_json_object("source_metadata", "$.has_attachments").alias("has_attachments"))


@query("src_mail_parts", f"""WITH {MAIL_SQL} SELECT doc_id, body AS body_text,
  CASE WHEN kind = 0 THEN '' ELSE '<p>' || body || '</p>' END AS body_html,
  CASE WHEN kind = 0 THEN '' ELSE 'f' || doc_id || '.pdf:' || doc_id END AS files FROM mb""")
def src_mail_parts(t: Tables):
    return mail.with_parts(mailbox(t)).select(
        "doc_id", "body_text", "body_html", F.array_join(F.transform(
            "attachments", lambda a: F.concat(a["filename"], F.lit(":"), a["size"])), ",").alias("files"))


@query("src_mail_labels", """SELECT sha256('g1:gmail://label/L_' || event_type || '_' || shard) AS id,
  event_type AS name, 'label' AS tags, n::VARCHAR AS f_total FROM (
  SELECT event_type, user_id % 6 AS shard, count(*) AS n FROM events GROUP BY ALL)""")
def src_mail_labels(t: Tables):
    rows = t.events.groupBy("event_type", (F.col("user_id") % 6).alias("shard")).agg(
        F.count("*").alias("total")).select(
        F.concat(F.lit("L_"), "event_type", F.lit("_"), "shard").alias("id"),
        F.col("event_type").alias("name"), "total")
    docs = mail.label_documents(rows, "g1")
    return docs.select("id", F.get_json_object("source_metadata", "$.name").alias("name"),
                       F.array_join("tags", "|").alias("tags"),
                       F.get_json_object(F.col("content").cast("string"), "$.total").alias("f_total"))


@query("flt_mail_labels", f"WITH {MAIL_SQL} SELECT doc_id, 'quiet' AS mode FROM mb WHERE work "
       "UNION ALL SELECT doc_id, 'spam' FROM mb WHERE work AND spam")
def flt_mail_labels(t: Tables):
    box, labels = mailbox(t), F.col("p.labelIds")
    wanted = ["INBOX", "WORK", "SPAM"]
    quiet = box.where(mail_labelled(labels, wanted)).select("doc_id", F.lit("quiet").alias("mode"))
    return quiet.unionByName(box.where(mail_labelled(labels, wanted, include_spam=True))
                             .select("doc_id", F.lit("spam").alias("mode")))


@query("fn_header_map", f"""WITH {MAIL_SQL} SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 3 ELSE 4 END AS n,
  sender, 'second' AS note FROM mb""")
def fn_header_map(t: Tables):
    h = header_map(F.col("p.payload.headers"))
    get = lambda k: F.try_element_at(h, F.lit(k))
    return mailbox(t).select("doc_id", F.size(h).alias("n"), get("from").alias("sender"),
                             get("x-note").alias("note"))


@query("fn_base64_urlsafe", "SELECT doc_id, text AS decoded FROM documents")
def fn_base64_urlsafe(t: Tables):
    coded = F.translate(F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"[\r\n=]", ""), "+/", "-_")
    return t.documents.select("doc_id", base64_urlsafe_text(coded).alias("decoded"))


# -------------------------------------------------------------------- threads


def threaded_mail(t: Tables):
    """One message per document, and copies of some.  A third of all is one
    thread with a chain of 120; then chains of seven, some of them below a lost
    message or in a circle; then references alone, to lost messages, no
    headers, no id, a reply to itself."""
    k = F.col("doc_id")
    mid = lambda n: F.concat(F.lit("<m"), n, F.lit("@x.test>"))
    j, i, g = F.expr("doc_id div 3"), F.expr("doc_id % 21 div 3"), F.expr("doc_id div 21")
    up = F.when(j <= 120, j - 1).otherwise(j % 120) * 3
    first = F.when(g % 3 == 1, F.concat(F.lit("<gone"), g, F.lit("@x.test>"))).when(g % 3 == 2, mid(k + 18))
    to = (F.when((k % 3 == 0) & (j > 0), mid(up)).when((k % 3 == 1) & (i > 0), mid(k - 3))
          .when(k % 3 == 1, first).when(k % 10 == 5, mid(k)))
    refs = (F.when((k % 3 == 0) & (j > 0), F.concat(F.lit("<m0@x.test>\r\n "), mid(up)))
            .when((k % 3 == 2) & (k % 2 == 0), F.concat(
                F.lit("<lost"), F.expr("doc_id div 30"), F.lit("@x.test> <nowhere"), k, F.lit("@x.test>"))))
    b64 = urlsafe(F.col("text"))
    headers = F.array_compact(F.array(*[
        F.when(v.isNotNull(), F.struct(F.lit(n).alias("name"), v.alias("value"))) for n, v in (
            ("Message-ID", F.when(k % 30 != 2, mid(k))), ("In-Reply-To", to), ("References", refs),
            ("Subject", F.concat(F.lit("S"), k)), ("From", F.concat(F.lit("a"), k % 9, F.lit("@x.test"))))]))
    rows = t.documents.select("doc_id", "text", F.explode(F.when(k % 40 == 0, F.array(F.lit(0), F.lit(1)))
                                                          .otherwise(F.array(F.lit(0)))).alias("copy"))
    payload = F.to_json(F.struct(
        F.concat(F.when(F.col("copy") == 1, "c").otherwise("m"), k).alias("id"),
        (F.lit(1704067200000) + k * 1000 + F.col("copy") * 5).cast("string").alias("internalDate"),
        F.struct(F.lit("text/plain").alias("mimeType"), headers.alias("headers"),
                 F.struct(b64.alias("data")).alias("body")).alias("payload")))
    return landed(rows.select("doc_id", payload.alias("payload")), mail.MESSAGE)


THREAD_SQL = """mm AS (SELECT doc_id AS k, text, doc_id // 3 AS j, doc_id % 21 // 3 AS i, doc_id // 21 AS g,
  CASE WHEN doc_id % 30 = 2 THEN 'row:m' || doc_id ELSE 'm' || doc_id || '@x.test' END AS node FROM documents),
mw AS (SELECT *, CASE
    WHEN k % 3 = 0 AND j > 0 THEN ['m' || (CASE WHEN j <= 120 THEN j - 1 ELSE j % 120 END * 3) || '@x.test', 'm0@x.test']
    WHEN k % 3 = 1 AND i > 0 THEN ['m' || (k - 3) || '@x.test']
    WHEN k % 3 = 1 AND g % 3 = 1 THEN ['gone' || g || '@x.test']
    WHEN k % 3 = 1 AND g % 3 = 2 THEN ['m' || (k + 18) || '@x.test']
    WHEN k % 3 = 2 AND k % 2 = 0 THEN ['nowhere' || k || '@x.test', 'lost' || (k // 30) || '@x.test']
    ELSE [] END AS ways FROM mm),
mc AS (SELECT node, unnest(ways) AS way, generate_subscripts(ways, 1) AS rank FROM mw),
mk AS (SELECT mc.node, min_by(way, rank) AS known FROM mc JOIN mm ON mm.node = mc.way GROUP BY 1),
mp AS (SELECT mw.*, coalesce(known, ways[len(ways)]) AS parent FROM mw LEFT JOIN mk USING (node)),
anc(node, up) AS (SELECT node, parent FROM mp WHERE parent IS NOT NULL
  UNION SELECT a.node, p.parent FROM anc a JOIN mp p ON p.node = a.up WHERE p.parent IS NOT NULL),
cut AS (SELECT node FROM anc a WHERE node IN (SELECT b.up FROM anc b WHERE b.node = a.node)
  GROUP BY node HAVING node = min(up)),
top AS (SELECT node AS root FROM mp WHERE parent IS NULL UNION SELECT node FROM cut
  UNION SELECT parent FROM mp WHERE parent IS NOT NULL AND parent NOT IN (SELECT node FROM mp)),
down(node, root, depth) AS (SELECT root, root, 0 FROM top
  UNION ALL SELECT p.node, d.root, d.depth + 1 FROM down d JOIN mp p ON p.parent = d.node
  WHERE p.node NOT IN (SELECT node FROM cut)),
placed AS (SELECT p.*, root, depth, 'm' || k AS id, 1704067200000 + k * 1000 AS ms FROM mp p JOIN down USING (node))"""


@query("jn_mail_replies", f"""WITH RECURSIVE {THREAD_SQL} SELECT node AS message_id,
  CASE WHEN node NOT IN (SELECT node FROM cut) THEN parent END AS parent_id, root AS thread_id,
  depth::BIGINT AS depth, id, ms AS sent FROM placed""")
def jn_mail_replies(t: Tables):
    return mail.replies(threaded_mail(t)).select("message_id", "parent_id", "thread_id", "depth", "id", "sent")


@query("src_mail_threads", f"""WITH RECURSIVE {THREAD_SQL} SELECT sha256('g1:gmail://thread/' || root) AS id,
  root AS thread_id, min_by(text_subject, depth * 100000000000000 + ms) AS subject, max(ms)::VARCHAR AS version,
  count(*)::VARCHAR AS messages, max(depth)::VARCHAR AS max_depth, sha256(string_agg(id || ':' || sha256(text), ','
  ORDER BY ms)) AS bodies FROM (SELECT *, 'S' || k AS text_subject FROM placed) GROUP BY root""")
def src_mail_threads(t: Tables):
    docs = mail.thread_documents(mail.replies(threaded_mail(t)), "g1")
    text = F.col("content").cast("string")
    each = F.from_json(F.get_json_object(text, "$.messages"), "array<struct<id:string,body_text:string>>")
    m = lambda f: F.get_json_object("source_metadata", f"$.{f}")
    return docs.select(
        "id", m("thread_id").alias("thread_id"), m("subject").alias("subject"), "source_ref.version",
        F.get_json_object(text, "$.message_count").alias("messages"), m("max_depth").alias("max_depth"),
        F.sha2(F.array_join(F.transform(each, lambda x: F.concat(x["id"], F.lit(":"), F.sha2(x["body_text"], 256))), ","),
               256).alias("bodies"))


# ---------------------------------------------------------------- raw messages


def raw_mail(t: Tables):
    """Raw messages: a text and its document attached; every third one forwards
    a message that has an attachment and, itself forwarded, another message."""
    k, nl = F.col("doc_id"), F.lit("\r\n")
    cat = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    coded = F.base64(F.encode("text", "UTF-8"))
    file = lambda name: cat("Content-Type: text/plain; charset=utf-8\r\nContent-Transfer-Encoding: base64\r\n"
                            "Content-Disposition: attachment;\r\n filename=\"", name, k, ".txt\"\r\n\r\n", coded, nl)
    mixed = lambda b: cat("Subject: S", k, "\r\nContent-Type: multipart/mixed; boundary=\"", b, k, "\"\r\n\r\npreamble\r\n")
    deepest = cat("Subject: last\r\n\r\nlast ", F.col("lang"), nl)
    inner = cat(mixed("in"), "--in", k, "\r\n\r\nsee below\r\n--in", k, nl, file("inner"), "--in", k,
                "\r\nContent-Type: message/rfc822\r\n\r\n", deepest, "--in", k, "--\r\n")
    raw = cat(mixed("out"), "--out", k, "\r\nContent-Type: text/plain; charset=utf-8\r\n\r\n", F.col("source"), "\r\n--out", k, nl,
              file("file"), F.when(k % 3 == 0, cat("--out", k, "\r\nContent-Type: message/rfc822\r\n\r\n", inner, nl)).otherwise(""),
              "--out", k, "--\r\nepilogue")
    return t.documents.select(k.alias("id"), F.encode(raw, "UTF-8").alias("raw"))


RAW_SQL = """rp AS (SELECT doc_id AS id, '1' AS path, 'text/plain' AS content_type, NULL::VARCHAR AS filename, source AS body FROM documents
  UNION ALL SELECT doc_id, '2', 'text/plain', 'file' || doc_id || '.txt', text FROM documents
  UNION ALL SELECT doc_id, '3.1', 'text/plain', NULL, 'see below' FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT doc_id, '3.2', 'text/plain', 'inner' || doc_id || '.txt', text FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT doc_id, '3.3.1', 'text/plain', NULL, 'last ' || lang FROM documents WHERE doc_id % 3 = 0)"""


@query("src_mail_raw_parts", f"""WITH {RAW_SQL} SELECT id, path, content_type, filename, filename IS NOT NULL AS attached,
  octet_length(encode(body))::BIGINT AS size, sha256(body) AS sha256 FROM rp""")
def src_mail_raw_parts(t: Tables):
    return mime.message_parts(raw_mail(t)).drop("content")


@query("src_mail_attachments", f"""WITH {RAW_SQL} SELECT sha256('g1:gmail://message/' || id || '/part/' || path) AS id,
  'gmail://message/' || id || '/part/' || path AS uri, sha256(body) AS checksum, octet_length(encode(body))::BIGINT AS size_bytes,
  'attachment|message:' || id AS tags, filename FROM rp WHERE filename IS NOT NULL""")
def src_mail_attachments(t: Tables):
    return mime.attachment_documents(mime.message_parts(raw_mail(t)), "g1").select(
        "id", "source_ref.uri", "checksum", "size_bytes", F.array_join("tags", "|").alias("tags"),
        F.get_json_object("source_metadata", "$.filename").alias("filename"))
