"""Mail messages, MIME parts, labels."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from harborline.catalog import values as V
from harborline.functions.codec import base64_urlsafe_text, header_map
from harborline.operators.envelope import envelope
from harborline.operators.filters import mail_labelled
from harborline.operators.forest import ascend, lookup
from harborline.operators.joins import nest, withheld
from harborline.session import materialize, once
from harborline.sources.common import KEEP_NULLS, json_doc, meta, tag, text_or

PART = ("struct<mime:string,filename:string,size:bigint,data:string,attachment_id:string,"
        "within_file:boolean>")
_BODY = "body:struct<data:string,size:bigint,attachmentId:string>"
# Two levels of parts are parsed; of a third it is only seen that there is one.
_LEAF = f"struct<mimeType:string,filename:string,{_BODY},parts:array<struct<mimeType:string>>>"
_NODE = f"struct<mimeType:string,filename:string,{_BODY},parts:array<{_LEAF}>>"
MESSAGE = ("id string, threadId string, snippet string, internalDate string, "
           "labelIds array<string>, payload struct<mimeType:string,filename:string,"
           f"headers:array<struct<name:string,value:string>>,{_BODY},parts:array<{_NODE}>>")


def _walker(max_attachment: int):
    """Arrow UDF: depth-first list of a message's parts, for trees of any depth."""
    def walk(text):
        if text is None:
            return None
        out, stack = [], [(json.loads(text), False)]
        while stack:
            node, inside = stack.pop()
            body = node.get("body") or {}
            name, size = node.get("filename") or "", body.get("size") or 0
            out.append({"mime": node.get("mimeType") or "", "filename": name, "size": size,
                        "data": body.get("data") or "",
                        "attachment_id": body.get("attachmentId") or "", "within_file": inside})
            # Children of an attachment are not part of the message body.
            hidden = inside or (bool(name) and size <= max_attachment)
            stack.extend((child, hidden) for child in reversed(node.get("parts") or []))
        return out

    @F.pandas_udf(f"array<{PART}>")
    def tree(payload: pd.Series) -> pd.Series:
        return payload.map(walk)

    return tree


def _flat(node: Column, inside: Column) -> Column:
    return F.struct(
        text_or(node["mimeType"]).alias("mime"), text_or(node["filename"]).alias("filename"),
        F.coalesce(node["body"]["size"], F.lit(0)).alias("size"),
        text_or(node["body"]["data"]).alias("data"),
        text_or(node["body"]["attachmentId"]).alias("attachment_id"),
        inside.alias("within_file"))


def parts(message_json: Column, parsed: Column,
          max_attachment: int = V.MAX_ATTACHMENT_BYTES) -> Column:
    """All MIME parts, depth first.  Messages with at most two levels of parts
    are flattened natively; only deeper trees go to Python."""
    root = parsed["payload"]
    deep = F.coalesce(F.exists(root["parts"], lambda p: F.exists(p["parts"], lambda q: F.size(q["parts"]) > 0)), F.lit(False))
    hides = lambda node: (F.length(text_or(node["filename"])) > 0) \
        & (F.coalesce(node["body"]["size"], F.lit(0)) <= max_attachment)
    none = F.array().cast(f"array<{PART}>")
    below = lambda node, inside, child: F.coalesce(F.flatten(F.transform(
        node["parts"], lambda p: child(p, inside | hides(node)))), none)
    leaf = lambda p, inside: F.array(_flat(p, inside).cast(PART))
    branch = lambda p, inside: F.concat(leaf(p, inside), below(p, inside, leaf))
    flat = F.concat(leaf(root, F.lit(False)), below(root, F.lit(False), branch))
    tree = _walker(max_attachment)(F.when(deep, F.get_json_object(message_json, "$.payload")))
    return F.when(deep, tree).otherwise(flat)


def split_parts(part_list: Column, max_attachment: int = V.MAX_ATTACHMENT_BYTES) -> dict[str, Column]:
    """Body text, body HTML and attachments.  A named part is an attachment
    when small enough and never a body."""
    seen = F.filter(part_list, lambda p: ~p["within_file"])
    body = lambda mime: text_or(base64_urlsafe_text(F.get(F.filter(
        seen, lambda p: (p["mime"] == mime) & (p["filename"] == "") & (p["data"] != "")), 0)["data"]))
    files = F.filter(seen, lambda p: (p["filename"] != "") & (p["size"] <= max_attachment))
    return {"body_text": body("text/plain"), "body_html": body("text/html"), "attachments": files}


def with_parts(rows: DataFrame, max_attachment: int = V.MAX_ATTACHMENT_BYTES) -> DataFrame:
    """Adds body_text, body_html, attachments to landed messages (`payload`
    JSON text, `p` parsed)."""
    split = once(rows, "_parts", parts(F.col("payload"), F.col("p"), max_attachment))
    return split.withColumns(split_parts(F.col("_parts"), max_attachment)).drop("_parts")


def messages(rows: DataFrame, instance_id: str, *, body_format: str = "text", labels=(),
             include_spam: bool = False,
             max_attachment: int = V.MAX_ATTACHMENT_BYTES, since_ms: int | None = None,
             seq: Column | None = None) -> DataFrame:
    """Landed messages (`payload`, `p`) -> JSON documents."""
    p = F.col("p")
    kept = rows.where(mail_labelled(F.coalesce(p["labelIds"], F.array().cast("array<string>")),
                                    labels, include_spam)) if labels else rows
    if since_ms is not None:
        kept = kept.where(p["internalDate"].try_cast("bigint") > since_ms)
    head = with_parts(kept, max_attachment).withColumn("h", header_map(p["payload"]["headers"]))
    h = lambda name, default="": text_or(F.try_element_at("h", F.lit(name)), default)
    wants = lambda kinds, c: F.col(c) if body_format in kinds else F.lit("")
    subject = h("subject", "(no subject)")
    lbl = F.coalesce(p["labelIds"], F.array().cast("array<string>"))
    content = json_doc(
        id=text_or(p["id"]), thread_id=text_or(p["threadId"]), subject=subject,
        **{"from": h("from")}, to=h("to"), date=h("date"), snippet=text_or(p["snippet"]),
        labels=lbl, body_text=wants(("text", "both"), "body_text"),
        body_html=wants(("html", "both"), "body_html"),
        attachments=F.transform("attachments", lambda a: F.struct(
            a["filename"].alias("name"), a["size"].alias("size"), a["mime"].alias("mime"))),
        internal_date=text_or(p["internalDate"]))
    return envelope(
        head, connector_id="gmail", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit("gmail://message/"), text_or(p["id"])), content=content,
        content_type="application/json",
        seq=seq if seq is not None else F.monotonically_increasing_id(),
        version=text_or(p["internalDate"]), cursor_value=text_or(p["internalDate"]),
        cursor_type="sequence", tags=["email", tag("thread:", p["threadId"])],
        metadata=meta(resource_type=F.lit("email"), msg_id=text_or(p["id"]),
                      thread_id=text_or(p["threadId"]), subject=subject, **{"from": h("from")},
                      to=h("to"), labels=lbl, internal_date=text_or(p["internalDate"]),
                      has_attachments=F.size("attachments") > 0))


def label_documents(rows: DataFrame, instance_id: str, seq: Column | None = None) -> DataFrame:
    """Labels (id, name, ...) -> JSON documents."""
    return envelope(
        rows, connector_id="gmail", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit("gmail://label/"), F.col("id")),
        content=F.to_json(F.struct(*rows.columns), KEEP_NULLS), content_type="application/json",
        seq=seq if seq is not None else F.monotonically_increasing_id(), tags=["label"],
        metadata=F.struct(F.lit("label").alias("resource_type"), *[F.col(c) for c in rows.columns]))


def _ids(header: Column) -> Column:
    """Message ids of a header's text."""
    return F.regexp_extract_all(text_or(header), F.lit(r"<([^<>\s]+)>"), 1)


def replies(rows: DataFrame) -> DataFrame:
    """Landed messages (`payload`, `p`) in their reply forest: message_id,
    parent_id, thread_id, depth, id, sent (milliseconds), sender, subject, snippet,
    body_text; one row per message id.

    A message's parent is the first landed message among those it replies to
    and, from the nearest on, those it refers to.  If none of them is landed,
    the topmost missing one still is its parent, so that all replies to a lost message
    share a thread.  Copies with the same message id are one message, the one
    sent first; messages without id stand for themselves, a message that
    replies to itself doesn't.  Where replies run in a circle, the smallest id
    opens the thread.

    References name a thread's first message in each of its messages, so these ids
    are looked up without giving a popular one to a single task; the way
    up is found by pointer jumping, in rounds that grow with the logarithm
    of the longest chain.
    """
    p = F.col("p")
    head = with_parts(rows, V.MAX_ATTACHMENT_BYTES).withColumn("h", header_map(p["payload"]["headers"]))
    h = lambda name: F.try_element_at("h", F.lit(name))
    own = F.coalesce(F.get(_ids(h("message-id")), F.lit(0)), F.concat(F.lit("row:"), text_or(p["id"])))
    seen = head.select(
        own.alias("message_id"), p["internalDate"].try_cast("bigint").alias("sent"), text_or(p["id"]).alias("id"),
        F.array_distinct(F.concat(_ids(h("in-reply-to")), F.reverse(_ids(h("references"))))).alias("ways"),
        text_or(h("from")).alias("sender"), text_or(h("subject"), "(no subject)").alias("subject"),
        text_or(p["snippet"]).alias("snippet"), "body_text")
    order = F.struct(F.col("sent").isNull(), "sent", "id")
    mails = materialize(seen.groupBy("message_id").agg(F.min_by(F.struct(*seen.columns), order).alias("m"))
                        .select("m.*").withColumn("ways", F.array_remove("ways", F.col("message_id"))), "mails")

    landed_ids = mails.select(F.col("message_id").alias("way"))
    asked = mails.select(F.col("message_id").alias("node"), F.posexplode("ways").alias("rank", "way"))
    found = lookup(materialize(asked, "ways"), landed_ids, "way", "inner") \
        .groupBy("node").agg(F.min_by("way", "rank").alias("known"))
    links = materialize(mails.join(found, F.col("message_id") == F.col("node"), "left").select(
        F.col("message_id").alias("node"),
        F.coalesce("known", F.try_element_at("ways", F.lit(-1))).alias("parent")).where("parent is not null"), "replies")
    placed = ascend(links).join(links, "node")
    return mails.drop("ways").join(placed.withColumnRenamed("node", "message_id"), "message_id", "left").select(
        "message_id", F.col("parent").alias("parent_id"), F.coalesce("root", "message_id").alias("thread_id"),
        F.coalesce("depth", F.lit(0)).alias("depth"), "id", "sent", "sender", "subject", "snippet", "body_text")


def thread_documents(messages: DataFrame, instance_id: str, seq: Column | None = None) -> DataFrame:
    """Rows of `replies` -> one JSON document per thread, its messages by time.

    The subject is that of the message nearest to the root.  A thread above the
    document limit keeps its messages where they are; their bytes count in its
    size, so validation rejects it.
    """
    messages = materialize(messages, "threads")
    near = F.struct("depth", F.col("sent").isNull(), "sent", "id")
    head = messages.groupBy("thread_id").agg(
        F.min_by("subject", near).alias("subject"), F.max("depth").alias("max_depth"),
        F.min("sent").alias("first_sent"), F.max("sent").alias("last_sent"))
    item = F.struct(*[F.col(c) for c in ("id", "message_id", "parent_id", "depth", "sender", "subject", "sent", "body_text")])
    full = nest(head, messages.select("thread_id", F.coalesce("sent", F.lit(0)).alias("_at"), F.col("id").alias("_id"),
                                      item.alias("_v")), ["thread_id"], F.col("_v"), ["_at", "_id"], "messages")
    col = F.col
    return envelope(
        full, connector_id="gmail", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit("gmail://thread/"), col("thread_id")), withheld=withheld("messages"),
        content=json_doc(thread_id=col("thread_id"), subject=col("subject"), message_count=col("messages_count"),
                         messages=col("messages")),
        content_type="application/json", seq=seq if seq is not None else F.monotonically_increasing_id(),
        version=col("last_sent"), cursor_value=col("last_sent"), cursor_type="sequence", tags=["thread"],
        metadata=meta(resource_type=F.lit("thread"), thread_id=col("thread_id"), subject=col("subject"),
                      message_count=col("messages_count"), max_depth=col("max_depth"),
                      first_sent=col("first_sent"), last_sent=col("last_sent")))
