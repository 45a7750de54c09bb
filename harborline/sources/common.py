"""Helpers shared by the sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from harborline.session import once

# JSON payloads keep their null fields, as the remote documents do.
KEEP_NULLS = {"ignoreNullFields": "false"}


def landed(rows: DataFrame, schema: str | T.StructType, column: str = "payload") -> DataFrame:
    """Parse a JSON text column against an explicit schema into `p`."""
    return once(rows, "p", F.from_json(column, schema))


def json_doc(**fields: Column) -> Column:
    """JSON object text with the given fields, in order."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), KEEP_NULLS)


def meta(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def text_or(c: Column, default: str = "") -> Column:
    return F.coalesce(c, F.lit(default))


def tag(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), text_or(c.cast("string")))


def iso(ts: Column, suffix: str = "") -> Column:
    """ISO-8601 text; six digits of microseconds, but only when there are any."""
    whole = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1_000_000)) == 0
    return F.concat(F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
                    .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), F.lit(suffix))


class SourceRegistry:
    """User sources by name: `(landed, cursors, options) -> envelope`."""

    def __init__(self):
        self._sources: dict[str, Callable[..., DataFrame]] = {}

    def register(self, name: str, source: Callable[..., DataFrame]) -> None:
        if name in self._sources:
            raise ValueError(f"source {name!r} is already registered")
        self._sources[name] = source

    def pull(self, name: str, landed_rows: DataFrame, cursors: DataFrame | None = None,
             **options) -> DataFrame:
        return self._sources[name](landed_rows, cursors, **options)
