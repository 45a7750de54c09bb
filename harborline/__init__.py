"""Harborline: Spark-native document acquisition.

Landed source payloads in, one canonical envelope table out, with validation,
de-duplication, a first-write-wins repository and the bookkeeping tables
around it. Everything is a DataFrame or Structured Streaming job.
"""

from harborline.session import build_session, prepare, shared_dir

__all__ = ["build_session", "prepare", "shared_dir"]
