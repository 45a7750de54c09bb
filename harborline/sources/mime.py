"""Parts of raw messages (RFC 5322 bytes), nested messages included.

A message is read once from front to back.  A stack holds the boundaries that are open;
a delimiter line of any of them ends the part at hand and, if it is an outer one, all
containers inside, so a missing closing line costs nothing but itself.  A part is handed
on as soon as it ends: besides the row's own bytes one decoded part is held.
"""

from __future__ import annotations

import binascii
import re
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa

from pyspark.sql import Column, DataFrame, functions as F

from harborline.operators.envelope import envelope
from harborline.session import prepare
from harborline.sources.common import meta, tag, text_or

#: Rows and bytes of a batch of parts that is handed on.
ROWS, BYTES = 500, 16 << 20

_PARAM = re.compile(r';\s*([\w.*-]+)\s*=\s*("(?:[^"\\]|\\.)*"|[^;\s]*)')


def _headers(raw: bytes, at: int) -> tuple[dict[str, str], int]:
    """Headers from `at` (first of each name, unfolded, lower-case names) and where
    the body starts."""
    out: dict[str, str] = {}
    name = None
    while at < len(raw):
        end = raw.find(b"\n", at)
        end = len(raw) if end < 0 else end + 1
        line = raw[at:end].rstrip(b"\r\n")
        if line[:1] in (b" ", b"\t") and name:
            if name in out:
                out[name] += " " + line.strip().decode("utf-8", "replace")
        elif not line:
            return out, end
        elif b":" in line and not line.startswith(b"--"):
            key, _, value = line.partition(b":")
            key = key.strip().lower().decode("latin-1")
            name = None if key in out else key
            if name:
                out[name] = value.strip().decode("utf-8", "replace")
        else:  # no header: the body has begun
            return out, at
        at = end
    return out, at


def _parameters(value: str) -> dict[str, str]:
    out = {}
    for key, text in _PARAM.findall(value):
        text = re.sub(r"\\(.)", r"\1", text[1:-1]) if text.startswith('"') else text
        if key.endswith("*") and text.count("'") >= 2:
            charset, _, coded = text.split("'", 2)
            try:
                text = unquote_to_bytes(coded).decode(charset or "utf-8", "replace")
            except LookupError:
                text = unquote_to_bytes(coded).decode("utf-8", "replace")
        out.setdefault(key.lower().rstrip("*"), text)
    return out


def _decoded(body: bytes, encoding: str) -> bytes:
    if encoding == "base64":
        kept = re.sub(rb"[^A-Za-z0-9+/]", b"", body)
        return binascii.a2b_base64(kept[:len(kept) - (len(kept) % 4 == 1)] + b"=" * (-len(kept) % 4))
    if encoding == "quoted-printable":
        return binascii.a2b_qp(body)
    return body


def read_parts(raw: bytes) -> Iterator[tuple[str, str, str | None, bool, bytes]]:
    """(path, type, filename, attached, decoded bytes) of every part that holds
    no others, front to back.  Paths count children from 1: `2.1` is the first part
    of the message, or container, that is the second part."""
    open_: list[tuple[bytes, str, list[int]]] = []  # boundary, path, children so far
    at, path, kind = 0, "", "text/plain"
    while True:
        head, at = _headers(raw, at)
        value = head.get("content-type", "")
        given = value.split(";")[0].strip().lower()
        kind = given if "/" in given else kind
        params = _parameters(";" + value.partition(";")[2])
        encoding = head.get("content-transfer-encoding", "").strip().lower()
        if kind == "message/rfc822" and encoding not in ("base64", "quoted-printable"):
            kind, path = "text/plain", path or "1"
            open_.append((b"", path, [0]))  # the message itself is a container of one
            continue
        container = kind.startswith("multipart/") and params.get("boundary")
        if container:
            open_.append((b"--" + params["boundary"].encode("utf-8", "replace"), path, [0]))
        start = at
        # the next delimiter line of any open boundary
        level, closing, stop = -1, False, len(raw)
        look = at
        while level < 0 and look < len(raw):
            if raw.startswith(b"--", look):
                end = raw.find(b"\n", look)
                line = raw[look:len(raw) if end < 0 else end].rstrip(b" \t\r")
                for i in range(len(open_) - 1, -1, -1):
                    mark = open_[i][0]
                    if mark and line in (mark, mark + b"--"):
                        level, closing, stop = i, line != mark, look
                        break
                if level >= 0:
                    at = len(raw) if end < 0 else end + 1
                    break
            after = raw.find(b"\n--", look)
            look = len(raw) if after < 0 else after + 1
        if not container:
            body = raw[start:stop]
            if level >= 0:
                body = body[:-2] if body.endswith(b"\r\n") else body[:-1] if body.endswith(b"\n") else body
            disposition = head.get("content-disposition", "")
            name = _parameters(";" + disposition.partition(";")[2]).get("filename") or params.get("name")
            inside = open_ and not open_[-1][0]
            yield (f"{path}.1" if inside and path == open_[-1][1] else path or "1", kind, name,
                   disposition.strip().lower().startswith("attachment") or bool(name), _decoded(body, encoding))
        while level >= 0 and closing:
            # behind a container comes nothing until the next delimiter of an outer one
            del open_[level:]
            while open_ and not open_[-1][0]:
                open_.pop()
            level, look = -1, at
            while level < 0 and look < len(raw):
                end = raw.find(b"\n", look)
                end = len(raw) if end < 0 else end
                line = raw[look:end].rstrip(b" \t\r")
                if line.startswith(b"--"):
                    for i in range(len(open_) - 1, -1, -1):
                        if open_[i][0] and line in (open_[i][0], open_[i][0] + b"--"):
                            level, closing, at = i, line != open_[i][0], end + 1
                            break
                after = raw.find(b"\n--", look)
                look = len(raw) if after < 0 else after + 1
        if level < 0:
            return
        del open_[level + 1:]
        open_[level][2][0] += 1
        above, number = open_[level][1], open_[level][2][0]
        path, kind = f"{above}.{number}" if above else str(number), "text/plain"


def message_parts(rows: DataFrame) -> DataFrame:
    """Raw messages (id, raw) -> id, path, content_type, filename, attached, size,
    sha256, content; one row per part that holds no others.

    Null messages have no parts, an empty one has one empty part.  A repeated id
    gives repeated parts.  Whatever is broken stays as it is: unknown encodings aren't
    decoded, a container that never closes ends with its message.
    """
    prepare(rows.sparkSession)
    names = ["id", "path", "content_type", "filename", "attached", "content"]
    kinds = [None, pa.string(), pa.string(), pa.string(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        kind = pa.int64()

        def emit():
            return pa.RecordBatch.from_arrays([pa.array(c, k or kind) for c, k in zip(zip(*out), kinds)], names)

        for batch in batches:
            kind = batch.column("id").type
            for i in range(batch.num_rows):
                raw = batch.column("raw")[i].as_py()
                for part in read_parts(raw) if raw is not None else ():
                    out.append((batch.column("id")[i].as_py(), *part))
                    held += len(part[-1])
                    if len(out) >= ROWS or held >= BYTES:
                        yield emit()
                        out, held = [], 0
        if out:
            yield emit()

    kind = rows.schema["id"].dataType.simpleString()
    told = rows.select("id", F.col("raw").cast("binary").alias("raw")).mapInArrow(
        run, f"id {kind}, path string, content_type string, filename string, attached boolean, content binary")
    return told.select("id", "path", "content_type", "filename", "attached", F.octet_length("content").cast("long").alias("size"),
                       F.sha2("content", 256).alias("sha256"), "content")


def attachment_documents(parts: DataFrame, instance_id: str, seq: Column | None = None) -> DataFrame:
    """Attached rows of `message_parts` -> one document each, with its bytes."""
    col = F.col
    return envelope(
        parts.where("attached"), connector_id="gmail", instance_id=F.lit(instance_id),
        uri=F.concat(F.lit("gmail://message/"), col("id"), F.lit("/part/"), col("path")), content=col("content"),
        content_type=col("content_type"), seq=seq if seq is not None else F.monotonically_increasing_id(),
        version=col("sha256"), tags=["attachment", tag("message:", col("id"))],
        metadata=meta(resource_type=F.lit("attachment"), msg_id=col("id").cast("string"), path=col("path"),
                      filename=text_or(col("filename")), size=col("size")))
