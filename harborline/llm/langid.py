"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with an elastic
net, then calibrated by one temperature.

Features are hashed runs of one to three characters of the lower-cased text,
everything but letters folded to one blank.  Document frequencies cover all
training rows.  The weights are fitted on a sample of about `sample` of them,
chosen by a hash of the row's content; a fifth of the sample is held back to
fit the temperature.  The model is classes x 65 536 numbers, whatever the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, functions as F

from harborline.llm.runtime import lean, prepare

UNKNOWN = "und"
DIMENSIONS = 1 << 16
#: Rows the weights are fitted on, about; at most twice as many.
SAMPLE = 6000
EPOCHS = 3

_OTHER = re.compile(r"[\W\d_]+")
_ASCII_LETTER = re.compile("[A-Za-z]")
_STEPS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def grams(text: str) -> np.ndarray:
    """Hashed one- to three-character runs of the whole text, in order."""
    plain = f" {_OTHER.sub(' ', text.lower()).strip()} "
    c = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint32(1)
    a = c * _STEPS[0]
    parts = [a]
    if len(c) > 1:
        b = (a[:-1] ^ (a[:-1] >> np.uint32(15))) * _STEPS[1] + c[1:] * _STEPS[2]
        parts.append(b)
    if len(c) > 2:
        parts.append((b[:-1] ^ (b[:-1] >> np.uint32(13))) * _STEPS[1] + c[2:] * _STEPS[0])
    x = np.concatenate(parts)
    return ((x ^ (x >> np.uint32(16))) * _STEPS[0]) >> np.uint32(16)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    count = np.bincount(grams(text), minlength=DIMENSIONS)
    at = np.flatnonzero(count)
    return at, count[at]


@dataclass
class Model:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, count = counted(text)
        x = (1 + np.log(count)) * self.idf[at]
        return at, x / max(np.sqrt(x @ x), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.classes or not has_letter(text):
            return UNKNOWN, 0.0
        at, x = self.features(text)
        p = _softmax((x @ self.weights[at] + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.classes[best], float(min(1.0, p[best]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit(rows: list[tuple[str, str]], idf: np.ndarray, *, alpha: float = 0.5, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.5, epochs: int = EPOCHS) -> Model:
    """Weights from (text, class) rows by per-coordinate FTRL-proximal; a fifth
    of the rows, by a checksum of their text, fits the temperature."""
    classes = sorted({label for _, label in rows})
    number = {label: k for k, label in enumerate(classes)}
    model = Model(classes, idf, np.zeros((DIMENSIONS, len(classes)), np.float32),
                  np.zeros(len(classes)), 1.0)
    if len(classes) < 2:
        return model
    coded = sorted(((zlib.crc32(t.encode("utf-8", "replace")), t, number[y]) for t, y in rows))
    held = [(t, y) for c, t, y in coded if c % 5 == 0]
    kept = [(*model.features(t), y) for c, t, y in coded if c % 5] or [
        (*model.features(t), y) for _, t, y in coded]
    z = np.zeros((DIMENSIONS + 1, len(classes)))
    n = np.zeros_like(z)

    def solved(at):
        s = z[at]
        return np.where(np.abs(s) <= l1, 0.0,
                        -(s - np.sign(s) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for at, x, y in kept:
            at1, x1 = np.append(at, DIMENSIONS), np.append(x, 1.0)
            w = solved(at1)
            p = _softmax(x1 @ w)
            p[y] -= 1
            g = np.outer(x1, p)
            grown = n[at1] + g * g
            z[at1] += g - (np.sqrt(grown) - np.sqrt(n[at1])) / alpha * w
            n[at1] = grown
    full = solved(np.arange(DIMENSIONS + 1))
    model.weights, model.bias = full[:-1].astype(np.float32), full[-1]
    if held:
        logits = np.array([x @ model.weights[at] + model.bias
                           for at, x in (model.features(t) for t, _ in held)])
        model.temperature = _temperature(logits, np.array([y for _, y in held]))
    return model


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, from a grid."""
    def loss(t):
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 93))
    return float(min(grid, key=loss))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, rows = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            df[counted(text)[0]] += 1
            rows += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1)), pa.array(np.append(df[at], rows))], ["gram", "n"])


def train(docs: DataFrame, *, text_col: str = "text", label_col: str = "lang",
          sample: int = SAMPLE) -> Model:
    """The model of all rows with a text that has a letter and a label.

    Document frequencies: one row per n-gram and task, summed by n-gram, so at
    most 65 536 rows reach the driver.  Sample: rows whose hash falls below
    sample / rows, at most 2 * sample of them.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("t"), F.col(label_col).cast("string").alias("y")) \
        .where("t is not null and y is not null and t rlike '\\\\p{L}'")
    found = (rows.select("t").mapInArrow(lean(_frequencies), "gram long, n long")
             .groupBy("gram").agg(F.sum("n").alias("n")).collect())
    df = np.zeros(DIMENSIONS)
    total = 0
    for r in found:
        if r.gram < 0:
            total = r.n
        else:
            df[r.gram] = r.n
    idf = np.log((1 + total) / (1 + df)) + 1
    if not total:
        return Model([], idf, np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0), 1.0)
    share = min(1.0, sample / total)
    chosen = rows.where(F.pmod(F.xxhash64("t", "y"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    return fit([(r.t, r.y) for r in chosen.limit(2 * sample).collect()], idf)


def predict(docs: DataFrame, model: Model, *, text_col: str = "text",
            keep: list[Column] | None = None) -> DataFrame:
    """`keep` columns of every row, lang_pred and score (0 to 1, calibrated).

    Null texts and texts without a letter: `und` with score 0, as are all rows
    if the model has no class.  Repeated rows give repeated rows.
    """
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)
    # Without `keep` the text passes through once, as a column of the rows.
    own = keep is None
    rows = docs if own else docs.select(*keep, F.col(text_col).alias("__text"))
    text = text_col if own else "__text"
    names = [c for c in rows.columns if c != "__text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema
                       if f.name != "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            got = [m.predict(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], [*names, "lang_pred", "score"])

    return rows.mapInArrow(lean(run), f"{schema}, lang_pred string, score double")
