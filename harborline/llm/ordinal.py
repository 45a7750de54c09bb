"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered
thresholds cut its score: P(grade > k) = sigmoid(w.x - t_k).  That gives the
expected grade and the probability of the upper tail, by which documents are
selected.

Features of a document are the distinct hashes of its lower-cased words, of
their first four and six bytes and last three bytes, and the decile of how many
words repeat and of how many characters are marks; each counts
1 / sqrt(number of features).  Whole texts are read.  The model is fitted on a
sample of about `sample` rated documents, by full-batch gradient steps with
Adam, so that the order of rows doesn't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, functions as F

from harborline.llm.words import IS_MARK, IS_SPACE, buffer, chunks, hash_spans, mix, spans, texts_of
from harborline.llm.runtime import prepare

BITS = 18
#: Rated documents the weights are fitted on, about; at most twice as many.
SAMPLE = 8000
STEPS = 150

_U = np.uint64


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text and where each text's begin."""
    buf, at = buffer(texts)
    starts, lengths, counts = spans(buf, at)
    doc = np.repeat(np.arange(len(texts)), counts)
    word = hash_spans(buf, starts, lengths)
    six, four = np.minimum(lengths, 6), np.minimum(lengths, 4)
    three = np.minimum(lengths, 3)
    groups = [word, hash_spans(buf, starts, six), hash_spans(buf, starts, four),
              hash_spans(buf, starts + lengths - three, three)]
    flat = [(mix(h + _U(k + 1)) >> _U(64 - BITS)).astype(np.int64) for k, h in enumerate(groups)]
    # documents x features as one number, so that one sort makes them distinct
    key = np.concatenate([(doc << BITS) | f for f in flat])
    order = np.lexsort((word, doc))
    same = np.zeros(len(word), bool)
    same[1:] = (word[order][1:] == word[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    repeats = np.bincount(doc[order][same], minlength=len(texts))
    marks = np.add.reduceat(IS_MARK[buf] & ~IS_SPACE[buf], at[:-1], dtype=np.int64)
    size = np.maximum(np.diff(at) - 1, 1)
    some = np.flatnonzero(counts)
    for k, share in enumerate((repeats / np.maximum(counts, 1), marks / size)):
        step = np.minimum((share * 10).astype(np.int64), 9)
        number = (mix((step + 1000 * (k + 1)).astype(np.uint64)) >> _U(64 - BITS)).astype(np.int64)
        key = np.concatenate((key, (some << BITS) | number[some]))
    key = np.unique(key)
    return key & ((1 << BITS) - 1), np.searchsorted(key >> BITS, np.arange(len(texts) + 1))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(self.weights[x])))
        return (total[bounds[1:]] - total[bounds[:-1]]) / np.sqrt(np.maximum(np.diff(bounds), 1))

    def tails(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """P(grade > k) for every document and threshold."""
        return _sigmoid(self.scores(x, bounds)[:, None] - self.thresholds[None, :])


def fit(x: np.ndarray, bounds: np.ndarray, grade: np.ndarray, grades: int, *, steps: int = STEPS,
        rate: float = 0.3, l2: float = 1e-6) -> Model:
    """Least penalised negative log-likelihood of the grades.  Thresholds are
    kept in order by fitting the first and the logarithms of the gaps."""
    n, size = len(grade), 1 << BITS
    doc = np.repeat(np.arange(n), np.diff(bounds))
    value = 1 / np.sqrt(np.maximum(np.diff(bounds), 1))
    w, free = np.zeros(size), np.zeros(grades - 1)
    free[0] = -1.0
    m, v = np.zeros(size + grades - 1), np.zeros(size + grades - 1)
    over = np.concatenate((np.ones((n, 1)), np.zeros((n, grades - 1)), np.zeros((n, 1))), axis=1)
    for step in range(1, steps + 1):
        gaps = np.exp(free[1:])
        t = free[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        s = np.bincount(doc, weights=w[x], minlength=n) * value
        up = _sigmoid(s[:, None] - t[None, :])
        over[:, 1:grades] = up  # P(grade > k-1), from 1 down to 0
        over[:, grades] = 0
        p = np.maximum(over[np.arange(n), grade] - over[np.arange(n), grade + 1], 1e-9)
        slope = up * (1 - up)
        pad = np.concatenate((np.zeros((n, 1)), slope, np.zeros((n, 1))), axis=1)
        hi, lo = pad[np.arange(n), grade], pad[np.arange(n), grade + 1]
        ds = -(hi - lo) / p / n
        dt = np.zeros(grades - 1)
        for k in range(grades - 1):
            dt[k] = ((hi / p)[grade == k + 1].sum() - (lo / p)[grade == k].sum()) / n
        dfree = np.concatenate(([dt.sum()], [dt[k:].sum() * gaps[k - 1] for k in range(1, grades - 1)]))
        g = np.concatenate((np.bincount(x, weights=(ds * value)[doc], minlength=size) + l2 * w, dfree))
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w -= move[:size]
        free -= move[size:] / 3
    return Model(w, free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:])))))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column("body"))
        for lo, hi in chunks(texts):
            x, bounds = features(texts[lo:hi])
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(x.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("grade").slice(lo, hi - lo), lists], ["grade", "x"])


def train(rated: DataFrame, *, text_col: str = "text", grade_col: str = "grade", sample: int = SAMPLE) -> Model | None:
    """The model of rows with a text and a whole grade from 0 up; None if
    there are fewer than two grades.  The sample is chosen by a hash of text
    and grade: about `sample` rows, at most twice as many."""
    prepare(rated.sparkSession)
    rows = rated.select(F.col(text_col).alias("body"), F.col(grade_col).cast("int").alias("grade")).where(
        "body is not null and grade >= 0")
    total = rows.count()
    share = min(1.0, sample / max(total, 1))
    chosen = rows.where(F.pmod(F.xxhash64("body", "grade"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    got = chosen.limit(2 * sample).mapInArrow(_featured, "grade int, x array<int>").toArrow()
    grade = np.asarray(got.column("grade").to_numpy(), np.int64)
    if len(np.unique(grade)) < 2:
        return None
    lists = got.column("x").combine_chunks()
    size = np.asarray(lists.value_lengths().to_numpy(), np.int64)
    x = np.asarray(lists.flatten().to_numpy(), np.int64)
    # a fixed order of rows, so that sums round alike in every run
    first = np.concatenate(([0], np.cumsum(size)))
    mark = np.bincount(np.repeat(np.arange(len(size)), size), weights=(x * 2654435761 % 1000003), minlength=len(size))
    order = np.lexsort((mark, size, grade))
    x = np.concatenate([x[first[i]:first[i + 1]] for i in order])
    return fit(x, np.concatenate(([0], np.cumsum(size[order]))), grade[order], int(grade.max()) + 1)


def score(docs: DataFrame, model: Model | None, *, text_col: str = "text", keep: list[Column] | None = None,
          tail: int | None = None) -> DataFrame:
    """`keep` columns of every row, expected_grade and tail_probability, the
    chance of a grade of `tail` (the highest, if not given) or more.

    Null texts count as empty; an empty text has no features, so it gets what
    the thresholds alone say.  Without a model both numbers are null.
    """
    prepare(docs.sparkSession)
    rows = docs.select(*(keep if keep is not None else [F.col(c) for c in docs.columns]),
                       F.col(text_col).alias("__text"))
    names = [c for c in rows.columns if c != "__text"]
    if model is None:
        return rows.select(*names, F.lit(None).cast("double").alias("expected_grade"),
                           F.lit(None).cast("double").alias("tail_probability"))
    at = (len(model.thresholds) if tail is None else tail) - 1
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            texts = texts_of(batch.column("__text"))
            for lo, hi in chunks(texts):
                up = m.tails(*features(texts[lo:hi]))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(lo, hi - lo) for c in names],
                     pa.array(up.sum(axis=1)), pa.array(up[:, at])], [*names, "expected_grade", "tail_probability"])

    return rows.mapInArrow(run, f"{schema}, expected_grade double, tail_probability double")
