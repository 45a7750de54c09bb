"""Registered queries: every operator over the driver's tables, each with the
same answer spelled in SQL where SQL can say it."""

from __future__ import annotations

from harborline.queries import registry
from harborline.queries import (  # noqa: F401  (registration on import)
    bookkeeping, chat_mail, codehost, core, crawl_web, intake, notes_wiki, streams, tables,
)

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
