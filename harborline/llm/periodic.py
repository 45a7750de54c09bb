"""Periodic runs of words inside a text: seed and extend on diagonals.

A run of period q matches itself q words on.  On that diagonal (lag q) it has
max(`LEAST` - q, q) equal words in a row at least, so a k-gram of that guaranteed
length occurs twice, q apart.  Lags are served in scales [k, 2k): lags below 12
by an index of six-grams, lags from 12, 24, 48, ... on by an index of k-grams
of that many words, each made of two of the scale before.  Pairs of occurrences
in the same document with a lag of the scale are seeds.  Per lag a table holds
how far the diagonal is covered; a seed below that mark isn't extended again.

Pairs are few even where a text is all repetition.  Occurrences at most k / 2
apart form a chain, which lies inside one run of a shorter period; two members of
one chain are no seed, for all they can give is that run again with a multiple
of its period.  Of two chains only pairs with the first member of either are taken:
the left end of every diagonal is such a pair, else it would go on to the left.

A diagonal's stretch is a run if it is long enough; of runs with equal start and
length the one with the smallest period stays.  Documents are joined to one
sequence per `CHUNK_BYTES`; word hashes are mixed with the document's number, so
nothing matches across.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from harborline.llm.runtime import prepare
from harborline.llm.words import buffer, chunks, combine, hash_spans, mix, spans, texts_of

#: A run has at least so many words, and at least two periods.
LEAST = 12
SEED = 6

_U = np.uint64
RUN = "struct<start: long, length: long, period: long>"


def _short(w: np.ndarray, h: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Stretches (first, words matched, lag) of lags below 2 * SEED.  Seeds that
    follow one another are one stretch, its end known without a look at words."""
    out = []
    for lag in range(1, 2 * SEED):
        same = h[:-lag] == h[lag:] if len(h) > lag else np.zeros(0, bool)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).view(np.int8)))
        first, end = edge[0::2], edge[1::2]
        out.append((first, end - first + SEED - 1, lag))
    return out


def _seeds(at: np.ndarray, h: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position, lag) of equal k-grams with a lag of [k, 2k), without
    those inside a chain and with the first of a chain on one side.  `at`:
    positions of k-grams that occur more than once, `h` their hashes."""
    order = np.lexsort((at, h))
    p, g = at[order], h[order]
    new = np.concatenate(([True], g[1:] != g[:-1]))
    head = new.copy()
    head[1:] |= np.diff(p) > k // 2
    chain = np.cumsum(head)
    key = (np.cumsum(new) - 1) * (n + 2 * k) + p  # lags never reach the next gram

    def pairs(sources: np.ndarray, targets: np.ndarray, sign: int) -> tuple[np.ndarray, np.ndarray]:
        reach = (key[sources] + k, key[sources] + 2 * k) if sign > 0 else (key[sources] - 2 * k + 1, key[sources] - k + 1)
        lo, hi = (np.searchsorted(key[targets], x) for x in reach)
        times = hi - lo
        a = np.repeat(sources, times)
        b = targets[np.repeat(lo - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())]
        ok = chain[a] != chain[b]
        return (a[ok], b[ok]) if sign > 0 else (b[ok], a[ok])

    heads, every = np.flatnonzero(head), np.arange(len(p))
    found = [pairs(heads, every, 1), pairs(heads, every, -1)]
    i, j = (p[np.concatenate(x)] for x in zip(*found))
    return i, j - i


def _end(w: np.ndarray, i: int, j: int) -> int:
    """First position from i on whose word differs from the one j - i on."""
    step, n = 64, len(w)
    while j < n:
        size = min(step, n - j)
        differ = np.flatnonzero(w[i:i + size] != w[j:j + size])
        if len(differ):
            return i + int(differ[0])
        i, j, step = i + size, j + size, step * 2
    return i


def find_runs(w: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """All runs of the sequence `w` as rows (start, length, period) by start and
    period.  `doc`: number of each word's document, ascending; words of
    different documents never are equal."""
    n = len(w)
    if n < LEAST:
        return np.zeros((0, 3), np.int64)
    h = w[:n - SEED + 1]
    for i in range(1, SEED):
        h = combine(h, w[i:n - SEED + 1 + i])
    found = [np.stack((a, m, np.full(len(a), lag)), axis=1) for a, m, lag in _short(w, h) if len(a)]

    # k-grams that occur once occur once in all longer ones, too
    k, grams = 2 * SEED, combine(h[:-SEED], h[SEED:])
    at = np.arange(len(grams))
    size = np.bincount(doc)[doc]
    while len(at):
        wide = size[at] >= 2 * k
        at, grams = at[wide], grams[wide]
        _, number, times = np.unique(grams, return_inverse=True, return_counts=True)
        again = times[number] > 1
        at, grams = at[again], grams[again]
        if not len(at):
            break
        i, lag = _seeds(at, grams, k, n)
        covered: dict[int, int] = {}  # per lag, how far its diagonal is known
        rows = []
        left = (i == 0) | (w[i - 1] != w[np.minimum(i - 1 + lag, n - 1)])
        order = np.lexsort((i[left], lag[left]))
        for a, q in zip(i[left][order].tolist(), lag[left][order].tolist()):
            if a >= covered.get(q, 0):
                covered[q] = _end(w, a, a + q)
                rows.append((a, covered[q] - a, q))
        if rows:
            found.append(np.array(rows, np.int64))
        # two neighbours make a gram of the next scale
        place = np.searchsorted(at, at + k)
        both = place < len(at)
        both[both] = at[place[both]] == at[both] + k
        at, grams, k = at[both], combine(grams[both], grams[place[both]]), 2 * k
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.concatenate(found)
    runs[:, 1] += runs[:, 2]
    runs = runs[runs[:, 1] >= np.maximum(LEAST, 2 * runs[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        first = np.concatenate(([True], (np.diff(runs[:, 0]) != 0) | (np.diff(runs[:, 1]) != 0)))
        runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Runs of all texts (positions within each), where each text's runs start
    (with the end of the last), and the texts' remaining words joined by spaces."""
    buf, at = buffer(texts, lower=False)
    starts, lengths, counts = spans(buf, at)
    doc = np.repeat(np.arange(len(texts)), counts)
    w = combine(hash_spans(buf, starts, lengths), mix(doc.astype(_U) + _U(1)))
    runs = find_runs(w, doc)
    first = np.concatenate(([0], np.cumsum(counts)))
    owner = doc[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    left = [b" ".join(t.split()) for t in texts]
    for d in np.unique(owner).tolist():
        own = runs[slice(*np.searchsorted(owner, [d, d + 1]))]
        words = texts[d].split()
        depth = np.zeros(len(words) + 1, np.int64)
        begin = own[:, 0] - first[d]
        np.add.at(depth, begin + own[:, 2], 1)
        np.add.at(depth, begin + own[:, 1], -1)
        keep = np.cumsum(depth[:-1]) == 0
        left[d] = b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])
    runs[:, 0] -= first[owner]
    return runs, np.searchsorted(owner, np.arange(len(texts) + 1)), left


def periodic_runs(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (default: all) of every row with `runs`, an array of
    (start, length, period) in words by start and period, and `collapsed`, the
    words that are in no run or among a run's first `period` words, joined by
    one space.

    Words are runs of characters other than ASCII white space and are compared
    as they stand.  Null and wordless texts have no runs and collapse to the
    empty text.  Rows are looked at one by one: repeated rows give repeated
    rows, no rows none.  Columns named `runs` or `collapsed` are replaced.
    Nothing is shuffled; a document is held whole by the task that reads it.
    """
    prepare(docs.sparkSession)
    names = [c for c in (keep or docs.columns) if c not in ("runs", "collapsed")]
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(names)], F.col(text_col).alias("body"))
    head = ", ".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(names)))
    fields = [f"k{i}" for i in range(len(names))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("body"))
            for lo, hi in chunks(texts):
                found, bounds, left = runs_of(texts[lo:hi])
                items = pa.StructArray.from_arrays(
                    [pa.array(found[:, i].astype(np.int64)) for i in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(lo, hi - lo) for c in fields],
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), items),
                     pa.array(left, pa.binary()).cast(pa.string())], [*fields, "runs", "collapsed"])

    told = rows.mapInArrow(run, f"{head + ', ' if head else ''}runs array<{RUN}>, collapsed string")
    return told.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)], "runs", "collapsed")


def digest(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row of `periodic_runs`: n_runs, the longest run (ties: smallest start,
    then period), its exponent in thousandths, and digests of all runs and of
    the collapsed text."""
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    return rows.withColumn("top", top).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_planted_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs`, in every tenth of which, by a hash of the id, the words from some
    place on repeat with some period; other texts and those without id stay.

    With h the crc32 of the id as text, g = h div 10 and n words, each word from
    a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    rows = docs.withColumn("__g", F.when(h % 10 == 0, F.floor(h / 10)))
    rows = rows.withColumn("__w", F.when(F.col("__g").isNotNull(), words))
    rows = rows.withColumn("__a", F.when(F.size("__w") > 0, F.col("__g") % F.size("__w")))
    rows = rows.withColumn("__p", F.expr("1 + (size(__w) - __a) div (3 + __g % 8)"))
    again = F.expr("array_join(transform(__w, (x, i) -> if(i < __a, x, __w[cast(__a + (i - __a) % __p as int)])), ' ')")
    return rows.withColumn(text_col, F.when(F.col("__a").isNotNull(), again).otherwise(F.col(text_col))) \
        .select(*docs.columns)
