"""Parts of raw messages against the standard library's tree of the whole message."""

import email
import email.policy
import hashlib
import random
from email.message import EmailMessage

from pyspark.sql import functions as F

from harborline.sources import mime


def tree(message, path=""):
    """Leaves of a parsed message, numbered like ours."""
    if message.get_content_type() == "message/rfc822":
        inner = message.get_payload()[0]
        yield from tree(inner, path or "1") if inner.is_multipart() else (
            (f"{path or '1'}.1" if p == (path or "1") else p, *rest) for p, *rest in tree(inner, path or "1"))
    elif message.is_multipart():
        for i, child in enumerate(message.get_payload(), 1):
            yield from tree(child, f"{path}.{i}" if path else str(i))
    else:
        yield path or "1", message.get_content_type(), message.get_filename(), message.get_payload(decode=True)


def message(rng, depth):
    m = EmailMessage()
    m["Subject"], m["From"] = "Größe " * 20, "a@b.c"
    m.set_content("".join(rng.choice(["line\n", "--not\n", "é = ü\n", "." * 90 + "\n"]) for _ in range(rng.randrange(0, 9))))
    if rng.random() < 0.4:
        m.add_alternative("<p>ü</p>", subtype="html")
    for i in range(rng.randrange(0, 3)):
        m.add_attachment(rng.randbytes(rng.randrange(0, 400)), maintype="application", subtype="pdf", filename=f"f{i} ü.pdf")
    if depth and rng.random() < 0.8:
        m.add_attachment(message(rng, depth - 1))
    return m


def test_parts_of_random_messages():
    rng = random.Random(3)
    seen = 0
    for _ in range(150):
        raw = message(rng, 3).as_bytes(policy=email.policy.SMTP if rng.random() < 0.5 else email.policy.default)
        want = list(tree(email.message_from_bytes(raw)))
        got = [(p, k, n, b) for p, k, n, _, b in mime.read_parts(raw)]
        assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
        assert [g[2] is None for g in got] == [w[2] is None for w in want]
        seen += sum("." in g[0] for g in got)
    assert seen > 100


BROKEN = {
    b"": [("1", "text/plain", b"")],
    b"Subject: x\n\nhello\n": [("1", "text/plain", b"hello\n")],
    b"no header at all": [("1", "text/plain", b"no header at all")],
    b"Content-Type: multipart/mixed; boundary=b\n\npre\n--b\n\none\n--b\nContent-Type: text/html\n\ntwo": [
        ("1", "text/plain", b"one"), ("2", "text/html", b"two")],
    b"Content-Type: multipart/mixed; boundary=\"o o\"\r\n\r\n--o o\r\nContent-Type: multipart/alternative; boundary=i\r\n\r\n--i\r\n\r\nA\r\n"
    b"--o o\r\n\r\nB\r\n--o o--\r\nend\r\n--o o\r\n": [("1.1", "text/plain", b"A"), ("2", "text/plain", b"B")],
    b"Content-Type: multipart/mixed\n\nno boundary": [("1", "multipart/mixed", b"no boundary")],
    b"Content-Transfer-Encoding: base64\n\nYWJj\nZA*=": [("1", "text/plain", b"abcd")],
    b"Content-Transfer-Encoding: base64\n\nYWJjZ": [("1", "text/plain", b"abc")],
    b"Content-Type: message/rfc822\n\nContent-Type: message/rfc822\n\nSubject: deep\n\nbody": [("1.1", "text/plain", b"body")],
}


def test_broken_messages():
    for raw, want in BROKEN.items():
        assert [(p, k, b) for p, k, _, _, b in mime.read_parts(raw)] == want, raw


def test_table_of_parts(spark):
    rng = random.Random(5)
    raws = [message(rng, 2).as_bytes() for _ in range(20)] + [None, b""]
    rows = spark.createDataFrame(list(enumerate(raws)) + [(None, raws[0])], "id long, raw binary")
    parts = mime.message_parts(rows)
    got = sorted((str(r.id), r.path, r.sha256, r.size) for r in parts.collect())
    assert got == sorted((str(i), p, hashlib.sha256(b).hexdigest(), len(b)) for i, raw in [*enumerate(raws), (None, raws[0])]
                         if raw is not None for p, _, _, _, b in mime.read_parts(raw))
    docs = mime.attachment_documents(parts, "g1").where(F.col("tags")[0] == "attachment").collect()
    assert docs and all(bytes(d.content) is not None and d.checksum == d.source_ref.version for d in docs)
    assert mime.message_parts(rows.limit(0)).count() == 0
