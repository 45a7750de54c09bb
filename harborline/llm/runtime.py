"""Session settings of this subpackage, and what its Python workers keep.

Workers outlive stages.  What each operator leaves in them adds up to the memory
of the next one, so a worker keeps the tables of one operator at a time and gives
freed memory back when a task ends.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa

from pyspark.sql import SparkSession

from harborline import session

# Texts go to Python in Arrow batches.  A batch is bounded by rows and, as a
# text can have any length, by bytes; results don't depend on either.  Both the
# executor and the worker hold several copies of a batch outside the heap.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession, size: int = 2 << 20) -> SparkSession:
    """`size`: bytes of a batch."""
    session.prepare(spark)
    for key, value in (BATCHES | {BYTES: str(size)}).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_KEPT: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """What `make` gives, built once per worker and kept until `kept` or `lean`
    is called with another key."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def _trim() -> None:
    """Freed memory goes back to the system, where its allocator can."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give:
        give(0)


def _rid(key: object) -> None:
    """Drops what is kept under other keys."""
    if _KEPT and key not in _KEPT:
        _KEPT.clear()
        _trim()


def lean(run: Callable[[Iterator], Iterable], key: object = None) -> Callable[[Iterator], Iterator]:
    """`run`, a function over batches, in a worker rid of what is kept under other
    keys; memory it frees is given back at its end."""
    def task(batches: Iterator) -> Iterator:
        _rid(key)  # a function of the module: `task` travels without the module's variables
        try:
            for out in run(batches):
                yield out
                _trim()
        finally:
            _trim()
    return task
