"""Paths, extensions, MIME types, globs, URLs."""

from __future__ import annotations

import fnmatch
from functools import reduce

from pyspark.sql import Column, functions as F

from harborline.catalog import values as V


def extension(path: Column) -> Column:
    """Lower-cased text from the last dot of the whole path on, or ''."""
    return (F.when(F.contains(path, F.lit(".")),
                   F.concat(F.lit("."), F.lower(F.substring_index(path, ".", -1))))
            .otherwise(F.lit("")))


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def mime_by_extension(path: Column) -> Column:
    """MIME type of a source file: known text types first, then the standard
    registry.  The table is a literal in the plan: no join, no shuffle."""
    table = {k: v for k, v in V.standard_mime_table().items()}
    table.update({e: V.TEXT_MIME.get(e, "text/plain") for e in V.TEXT_EXTENSIONS})
    return F.coalesce(F.try_element_at(literal_map(table), extension(path)),
                      F.lit(V.DEFAULT_MIME))


def mime_by_object_key(key: Column) -> Column:
    """MIME type of a stored object: a compression suffix is looked through,
    then the standard registry decides on the last extension of the name."""
    name = F.substring_index(key, "/", -1)
    shorthand = F.regexp_replace(name, r"(?i)\.(tgz|taz|tz|tbz2|txz)$", ".tar")
    inner = F.regexp_replace(shorthand, r"(.)\.(gz|Z|bz2|xz|br)$", "$1")
    ext = F.lower(F.regexp_extract(inner, r"[^.](\.[^.]*)$", 1))
    return F.coalesce(F.try_element_at(literal_map(V.standard_mime_table()), ext),
                      F.lit(V.DEFAULT_MIME))


def mime_major(content_type: Column) -> Column:
    return F.concat(F.substring_index(content_type, "/", 1), F.lit("/*"))


def mime_allowed(content_type: Column, allowed) -> Column:
    """True when the type, its `major/*` or `*/*` is in the allow-list."""
    allowed = list(allowed)
    if "*/*" in allowed:
        return F.lit(True)
    return content_type.isin(allowed) | mime_major(content_type).isin(allowed)


def glob_regex(patterns) -> str:
    """One anchored regular expression for any of several globs (`*` crosses
    `/`), compiled on the driver so that tasks run a single `rlike`."""
    parts = [fnmatch.translate(p).replace(r"\Z", "").replace(r"\z", "") for p in patterns]
    return r"\A(?:" + "|".join(parts) + r")\z"


def matches_any_glob(path: Column, patterns) -> Column:
    return path.rlike(glob_regex(patterns))


def branch_of_ref(ref: Column) -> Column:
    return F.substring_index(F.coalesce(ref, F.lit("refs/heads/main")), "/", -1)


def url_host(url: Column) -> Column:
    """Network location: what stands between `//` and the next / ? or #."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def url_allowed(url: Column, domains, patterns=V.CRAWL_EXCLUDE_PATTERNS) -> Column:
    """Not hit by an exclude pattern and on an allowed host.  `domains` is a
    list of hosts or a boolean Column computed elsewhere (e.g. a join)."""
    excluded = reduce(lambda a, b: a | b, [url.rlike(p) for p in patterns])
    on_host = domains if isinstance(domains, Column) else url_host(url).isin(list(domains))
    return ~excluded & on_host
