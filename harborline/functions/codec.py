"""Signatures, base64, JSON paths, headers, dates."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F

from harborline.catalog import values as V


def _pads(secret: bytes) -> tuple[str, str]:
    """Inner and outer HMAC key blocks, hex, worked out once on the driver."""
    key = hashlib.sha256(secret).digest() if len(secret) > 64 else secret
    block = key.ljust(64, b"\0")
    return (bytes(b ^ 0x36 for b in block).hex(), bytes(b ^ 0x5C for b in block).hex())


def hmac_sha256(secret: str, message: Column) -> Column:
    """Hex HMAC-SHA256 of a binary column, built from two native `sha2`."""
    inner_pad, outer_pad = _pads(secret.encode())
    inner = F.sha2(F.concat(F.unhex(F.lit(inner_pad)), message.cast("binary")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer_pad)), F.unhex(inner)), 256)


def body_signature_valid(secret: str | None, body: Column, header: Column) -> Column:
    """Code-host rule: header must be `sha256=` + hex of the body's HMAC."""
    if not secret:
        return F.lit(True)
    expected = F.concat(F.lit("sha256="), hmac_sha256(secret, body))
    return F.coalesce(header == expected, F.lit(False))


def chat_signature_valid(secret: str | None, body: Column, timestamp: Column,
                         header: Column, received_at_s: Column) -> Column:
    """Chat rule: `v0:ts:body` signed, both headers present, at most five
    minutes old.  Without a secret every delivery is accepted."""
    if not secret:
        return F.lit(True)
    base = F.concat(F.encode(F.concat(F.lit("v0:"), timestamp, F.lit(":")), "UTF-8"),
                    body.cast("binary"))
    signed = F.concat(F.lit("v0="), hmac_sha256(secret, base)) == header
    fresh = F.abs(received_at_s - timestamp.try_cast("double")) <= V.SIGNATURE_WINDOW_S
    present = (F.length(timestamp) > 0) & (F.length(header) > 0)
    return F.coalesce(present & fresh & signed, F.lit(False))


def base64_urlsafe_text(data: Column) -> Column:
    """URL-safe base64 (padding optional) -> text, bad bytes replaced."""
    # Usually there is nothing to take out but padding, which one look tells.
    tidy = data.rlike("^[A-Za-z0-9_-]*+={0,2}$")
    bare = F.when(tidy, F.rtrim(data, F.lit("="))).otherwise(F.regexp_replace(data, "[^A-Za-z0-9+/_-]", ""))
    coded = F.replace(F.replace(bare, F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))
    # The decoder takes unpadded text, but no single character at the end.  The lambda
    # has its argument evaluated once.
    raw = F.get(F.transform(F.array(coded), lambda b: F.when(F.length(b) % 4 != 1, F.unbase64(b))), 0)
    return F.make_valid_utf8(raw.cast("string"))


def json_path(doc: Column, path: str) -> Column:
    """Dotted path lookup in JSON text; null when a step is missing or not an
    object; the empty path is the document itself."""
    if not path:
        return doc
    return F.get_json_object(doc, "$" + "".join(f"['{step}']" for step in path.split(".")))


def header_map(headers: Column) -> Column:
    """List of (name, value) -> map with lower-cased names; the last value of
    a name wins (map key policy LAST_WIN, see `session.prepare`)."""
    return F.map_from_entries(F.transform(
        F.coalesce(headers, F.array()), lambda h: F.struct(F.lower(h["name"]), h["value"])))


def lower_keys(headers: Column) -> Column:
    """Map with lower-cased keys; on a clash the later entry wins."""
    return F.transform_keys(headers, lambda k, _: F.lower(k))


def feed_epoch(text: Column) -> Column:
    """Feed date -> epoch seconds (double), 0 when there is none to read.
    The weekday name is dropped first; it carries no information."""
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s+", "")
    tries = [F.try_to_timestamp(bare, F.lit(f)) for f in V.FEED_DATE_FORMATS]
    micros = F.unix_micros(F.coalesce(*tries))
    return F.coalesce(micros / F.lit(1_000_000.0), F.lit(0.0))


def lsn_order(lsn: Column) -> Column:
    """Sortable number of a `HI/LO` hexadecimal log position."""
    hi = F.conv(F.substring_index(lsn, "/", 1), 16, 10).cast("decimal(20,0)")
    lo = F.conv(F.substring_index(lsn, "/", -1), 16, 10).cast("decimal(20,0)")
    return (hi * F.lit(4294967296).cast("decimal(20,0)") + lo).cast("decimal(38,0)")
