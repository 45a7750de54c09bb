"""Near-duplicates: fast similarity sketching, banding, exact verification.

Sketch (Dahlgaard, Knudsen, Thorup, 2017): `size` coordinates, 2 * size rounds.
In round i every shingle goes to a hashed bin with value (i, hash); from round
`size` on, to bin i - size.  A coordinate keeps its least value; a document
stops once all its coordinates are filled, which the last rounds guarantee.
Coordinates of two sets agree with probability equal to their similarity and
concentrate as if they were independent.

Documents with the same shingle set are one class and only its smallest id
takes part.  Classes that share a band are candidates.  Links are confirmed on
full sets, recomputed from the texts of candidates alone.  A bucket is not
expanded to pairs: first its members are held against the one nearest to its
middle.  Buckets with members that are still in different components are then
searched whole, in blocks of bounded size, by counting common shingles through
an index; only links come out, one per pair of components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from harborline.llm.components import components
from harborline.llm.words import buffer, chunks, combine, hash_spans, mix, spans, texts_of
from harborline.llm.runtime import lean, prepare
from harborline.session import materialize

SHINGLE = 5
#: 25 bands of 6 rows: a pair of similarity 0.85 is missed with probability 7e-6.
BANDS, ROWS = 25, 6
PERCENT = 85
#: Ids of candidates are sent to all tasks up to this many (16 MB), beyond that joined by a shuffle.
BROADCAST_IDS = 1_000_000

#: Members of a bucket that are looked at together.
BLOCK = 2000

_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def shingles(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each
    text's start (with the end of the last)."""
    buf, at = buffer(texts)
    starts, lengths, counts = spans(buf, at)
    h = hash_spans(buf, starts, lengths)
    first = np.concatenate(([0], np.cumsum(counts)))
    doc = np.repeat(np.arange(len(texts)), counts)
    if len(h) >= n:
        w = h[:len(h) - n + 1]
        for k in range(1, n):
            w = combine(w, h[k:len(h) - n + 1 + k])
        whole = doc[:len(w)] == doc[n - 1:]
        w, owner = w[whole], doc[:len(w)][whole]
    else:
        w, owner = h[:0], doc[:0]
    few = np.flatnonzero((counts > 0) & (counts < n))
    extra = np.zeros(len(few), np.uint64)
    for j, d in enumerate(few):
        x = _U(counts[d])
        for y in h[first[d]:first[d] + counts[d]]:
            x = combine(np.array([x]), np.array([y]))[0]
        extra[j] = x
    w, owner = np.concatenate((w, extra)), np.concatenate((owner, few))
    order = np.lexsort((w, owner))
    w, owner = w[order], owner[order]
    if len(w):
        new = np.concatenate(([True], (w[1:] != w[:-1]) | (owner[1:] != owner[:-1])))
        w, owner = w[new], owner[new]
    return w, np.searchsorted(owner, np.arange(len(texts) + 1))


def sketch(w: np.ndarray, bounds: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Documents x size coordinates; rows of empty sets stay unfilled."""
    n = len(bounds) - 1
    out = np.full(n * size, _EMPTY)
    doc = np.repeat(np.arange(n), np.diff(bounds))
    item = w
    for i in range(2 * size):
        if not len(item):
            break
        v = mix(item + _U((0x9E3779B97F4A7C15 * (i + 1)) & 0xFFFFFFFFFFFFFFFF))
        bins = ((v >> _U(40)) % _U(size)).astype(np.int64) if i < size else i - size
        value = (_U(i) << _U(40)) | (v & _U((1 << 40) - 1))
        np.minimum.at(out, doc * size + bins, value)
        open_ = (out.reshape(n, size) == _EMPTY).any(axis=1)[doc]
        item, doc = item[open_], doc[open_]
    return out.reshape(n, size)


def _sign(batches: Iterator[pa.RecordBatch], count: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column("body"))
        for lo, hi in chunks(texts):
            w, bounds = shingles(texts[lo:hi])
            size = np.diff(bounds)
            total = np.concatenate(([_U(0)], np.cumsum(mix(w), dtype=np.uint64)))
            other = np.concatenate(([_U(0)], np.cumsum(mix(w ^ _U(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)))
            s = sketch(w, bounds, count * rows).reshape(hi - lo, count, rows)
            key = np.broadcast_to(np.arange(count, dtype=np.uint64), (hi - lo, count)).copy()
            for r in range(rows):
                key = combine(key, s[:, :, r])
            flat = pa.array(key.reshape(-1).view(np.int64))
            bands = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * count), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(lo, hi - lo), pa.array(size.astype(np.int64)),
                 pa.array((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)),
                 pa.array((other[bounds[1:]] - other[bounds[:-1]]).view(np.int64)), bands],
                ["id", "n", "f", "g", "bands"])


def _compare(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = texts_of(batch.column("ta")), texts_of(batch.column("tb"))
        linked = np.zeros(len(left), bool)
        for lo, hi in chunks([x + y for x, y in zip(left, right)]):
            w, b = shingles(left[lo:hi] + right[lo:hi])
            m = hi - lo
            for k in range(m):
                x, y = w[b[k]:b[k + 1]], w[b[m + k]:b[m + k + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked[lo + k] = 100 * both >= percent * (len(x) + len(y) - both)
        keep = pa.array(linked)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def _across(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between members of a bucket that are in different components, one
    per pair of components that has any.  Common shingles are counted through
    an index from shingle to members."""
    frame = frame.sort_values("id", ignore_index=True)
    w, bounds = shingles([x or b"" for x in frame["body"].map(lambda t: t and t.encode())])
    size, m = np.diff(bounds), len(frame)
    member = np.repeat(np.arange(m), size)
    order = np.argsort(w, kind="stable")
    listed, w_sorted = member[order], w[order]
    lo, hi = np.searchsorted(w_sorted, w, "left"), np.searchsorted(w_sorted, w, "right")
    ids = frame["id"].to_numpy()
    component = np.unique(frame["component"].to_numpy(), return_inverse=True)[1]
    largest = int(np.bincount(component).argmax())
    out: dict[tuple, tuple] = {}
    for x in np.flatnonzero(component != largest).tolist():
        a, z = lo[bounds[x]:bounds[x + 1]], hi[bounds[x]:bounds[x + 1]]
        a, z = a[z - a > 1], z[z - a > 1]
        if not len(a):
            continue
        common = np.bincount(np.concatenate([listed[i:j] for i, j in zip(a, z)]), minlength=m)
        linked = (100 * common >= percent * (size[x] + size - common)) & (component != component[x])
        for y in np.flatnonzero(linked).tolist():
            key = (min(component[x], component[y]), max(component[x], component[y]))
            out.setdefault(key, (max(ids[x], ids[y]), min(ids[x], ids[y])))
    return pd.DataFrame(list(out.values()), columns=["a", "b"])


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document row: `id_col`, n_shingles (distinct five-word
    shingles; fewer words are one shingle), component_id (smallest id linked by
    a chain of pairs of similarity `percent` / 100 or more, itself included), kept.
    A pair of similarity s is missed with probability (1 - s ** rows) ** bands.

    Null or wordless texts have no shingles and link with nothing.  Rows
    without id are linked with nothing, have a null component and are kept.
    Rows that repeat an id are one document in the graph and stay rows.
    Further columns are ignored; an empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    kind = texts.schema["id"].dataType.simpleString()
    signed = materialize(texts.mapInArrow(
        lean(lambda batches: _sign(batches, bands, rows)), f"id {kind}, n long, f long, g long, bands array<long>"), "signed")
    classes = materialize(
        signed.where("id is not null and n > 0").groupBy("n", "f", "g")
        .agg(F.min("id").alias("head"), F.first("bands").alias("bands")), "classes")
    buckets = classes.select("head", "n", F.posexplode("bands").alias("band", "key"))
    several = buckets.groupBy("band", "key").agg(F.count("*").alias("m")).where("m > 1")
    members = materialize(buckets.join(several, ["band", "key"]), "buckets")
    # The member that shares most bands with others lies nearest to the middle of its group.
    shared = members.groupBy("head").agg(F.sum("m").alias("shared"))
    middle = (members.join(shared, "head").groupBy("band", "key")
              .agg(F.max(F.struct("shared", F.col("head").alias("pivot"))).alias("top"))
              .select("band", "key", "top.pivot"))
    ids = materialize(shared.select(F.col("head").alias("id")), "candidates")
    # An id that is repeated with other texts is held against others with each of them.
    near = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    bodies = materialize(texts.join(near, "id", "left_semi").dropDuplicates(["id", "body"]), "bodies")

    weigh = classes.select("head", "n")
    tested = (members.join(middle, ["band", "key"]).where("head <> pivot")
              .select(F.greatest("head", "pivot").alias("a"), F.least("head", "pivot").alias("b")).distinct()
              .join(weigh.select(F.col("head").alias("a"), F.col("n").alias("na")), "a")
              .join(weigh.select(F.col("head").alias("b"), F.col("n").alias("nb")), "b")
              .where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b").distinct())
    links = materialize(
        tested.join(bodies.select(F.col("id").alias("a"), F.col("body").alias("ta")), "a")
        .join(bodies.select(F.col("id").alias("b"), F.col("body").alias("tb")), "b")
        .select("a", "b", "ta", "tb").mapInArrow(
            lean(lambda batches: _compare(batches, percent)), f"a {kind}, b {kind}").distinct(), "links")

    # Buckets whose members are still in different components, in blocks of bounded size.
    own = components(links).withColumnRenamed("node", "head")
    known = members.join(own, "head", "left").withColumn("component", F.coalesce("component", "head"))
    mixed = known.groupBy("band", "key").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1")
    block = F.pmod(F.xxhash64("head"), F.ceil(F.col("m") / BLOCK)).cast("int")
    apart = (known.join(mixed, ["band", "key"]).withColumn("i", block)
             .withColumn("j", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("m") / BLOCK) - 1).cast("int"))))
             .select("band", "key", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"),
                     F.col("head").alias("id"), "component")
             .join(bodies, "id"))
    more = apart.groupBy("band", "key", "lo", "hi").applyInPandas(
        lambda frame: _across(frame, percent), f"a {kind}, b {kind}")
    links = links.union(materialize(more.distinct(), "links"))
    alike = signed.where("id is not null and n > 0").join(
        classes.select("n", "f", "g", "head"), ["n", "f", "g"]).where("id <> head") \
        .select(F.col("id").alias("a"), F.col("head").alias("b"))
    own = components(links.union(alike))
    return (signed.select("id", "n").join(own.withColumnRenamed("node", "id"), "id", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id"),
                    F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept")))
