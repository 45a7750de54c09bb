"""What backing off holds of a group of histories."""

import tracemalloc

import numpy as np
import pyarrow as pa

from harborline.llm import katz


def test_backing_off_holds_few_bytes_a_history():
    r = np.random.default_rng(3)
    buckets, n = 16, 40_000
    rows = []
    for _ in range(buckets):
        hist = np.unique(r.integers(1, 1 << 62, n).astype(np.uint64))
        rows.append(("history", 0, katz._pack(np.diff(hist, prepend=np.uint64(0)), *[
            katz._small(r.integers(0, 3, len(hist))) for _ in range(2 * katz.K + 1)])))
    asked = hist[:1000]
    rows.append(("event", 0, katz._pack(np.diff(asked, prepend=np.uint64(0)), katz._small(np.full(1000, 2)),
                                        np.array([7, 9], np.uint64), katz._small(np.arange(2000) % 2), katz._small(np.arange(2000) % 50))))
    table = pa.table(dict(zip(("kind", "key", "data"), (pa.array(c, t) for c, t in zip(
        zip(*rows), (pa.string(), pa.int64(), pa.binary()))))))
    back = katz._back([0.5] * katz.K, [0.5] * katz.K, 10 ** 9)
    tracemalloc.start()
    out = back(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(out.column("key").to_pylist()) == [7, 9]
    assert peak < 110 * buckets * n
