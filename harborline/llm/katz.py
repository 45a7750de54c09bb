"""Katz backoff bigram scoring with Good-Turing discounts.

Tokens are lower-cased words and one end per document; the first token follows
a start.  With c the training counts, N all tokens and d the Good-Turing
discounts of counts up to five (one beyond),

    P(w | h) = d c(h,w) / (c(h) + 1)      if h w was seen
             = a(h) P(w)                  otherwise
    P(w)     = d' c(w) / (N + 1)          if w was seen, else what is left

a(h) is such that the sum over all seen words and one unknown word is exactly
one.  The one added to c(h) and N keeps some mass to back off with where no
count is small enough to be discounted.

A token costs one shuffled entry.  Tasks number their documents, cut their tokens
into buckets by the word and send each bucket as compressed arrays (word, history,
document's number).  A bucket then holds all of c(w) and c(h,w) of its words and all
documents that ask for them, so it counts and evaluates at once.  What needs other
buckets is additive and leaves as compressed arrays, too: a document's sums, to its task's
group; per history the numbers that make up a(h), and the documents that back off
from it, to the history's group.  Words with more than `HOT` of all tokens are split
further by history; their exact counts, a few hundred at most, are sent to all tasks.

The model is written as tables partitioned by kind (unigram, bigram, history).
Words are 64-bit hashes: two of a billion words meet with probability 0.03.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

from pyspark.sql import Column, DataFrame, functions as F

from harborline.llm.words import buffer, chunks, combine, hash_spans, mix, spans, texts_of
from harborline.llm.runtime import prepare
from harborline.session import shared_dir

K = 5
END, START = np.uint64(1), np.uint64(2)
#: Text bytes whose tokens make a bucket, about, and tokens that are cut into buckets at a time.
BUCKET_BYTES = 8 << 20
FLUSH = 1_500_000
#: Buckets whose histories make a group.
HISTORY_BUCKETS = 8
#: Share of tokens from which a word is split, and how many ways; estimated on one document of `SAMPLED`.
HOT, WAYS, SAMPLED = 0.002, 64, 16

_U = np.uint64
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts with an end each, the token before each, and
    how many tokens each text has."""
    buf, at = buffer(texts)
    starts, lengths, counts = spans(buf, at)
    w = np.full(len(starts) + len(texts), END)
    bounds = np.cumsum(counts + 1)
    word = np.ones(len(w), bool)
    word[bounds - 1] = False
    w[word] = hash_spans(buf, starts, lengths) | _U(4)  # apart from end and start
    h = np.empty_like(w)
    h[1:] = w[:-1]
    h[0] = START
    h[bounds[:-1]] = START
    return w, h, counts + 1


def _part(w: np.ndarray, h: np.ndarray, buckets: int, hot: np.ndarray) -> np.ndarray:
    """Bucket of each token: of its word, or of word and history if hot."""
    b = mix(w) % _U(buckets)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, w), len(hot) - 1)
        split = hot[at] == w
        b[split] = combine(w[split], mix(h[split]) % _U(WAYS)) % _U(buckets)
    return b.astype(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(
        [np.array([x.itemsize for x in arrays] + [len(x) for x in arrays], "<u8").tobytes(),
         *[x.tobytes() for x in arrays]]))


def _unpack(data: bytes, kinds: list[str]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    k = len(kinds)
    sizes = np.frombuffer(raw, "<u8", 2 * k).astype(np.int64)
    out, at = [], 16 * k
    for i in range(k):
        kind = f"<{kinds[i]}{sizes[i]}"
        out.append(np.frombuffer(raw, kind, sizes[k + i], at))
        at += int(sizes[i] * sizes[k + i])
    return out


def _coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values as differences, and the number of each element's."""
    values, number = np.unique(x, return_inverse=True)
    small = np.uint16 if len(values) <= 1 << 16 else np.uint32
    return np.diff(values, prepend=_U(0)), number.astype(small)


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in as few bytes each as the largest needs."""
    most = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def _cut(buckets: int, hot: np.ndarray):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, flushes = [], 0, 0

        def flush(task: int):
            w, h, keys, train = (np.concatenate([r[i] for r in held]) for i in (0, 1, 3, 4))
            base = np.concatenate(([0], np.cumsum([len(r[3]) for r in held])))
            doc = np.concatenate([r[2] + base[i] for i, r in enumerate(held)])
            name = (task << 24) + flushes
            part = _part(w, h, buckets, hot)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(buckets + 1))
            # who the documents are goes to a group of its own
            rows = [(-1 - name, name, _pack(keys, train))]
            learn = np.packbits(train)
            for b in range(buckets):
                at = order[edges[b]:edges[b + 1]]
                if len(at):
                    at = at[np.argsort(w[at], kind="stable")]
                    wv, wn = _coded(w[at])
                    hv, hn = _coded(h[at])
                    runs = _small(np.bincount(wn))
                    rows.append((b, name, _pack(wv, runs, hv, hn, _small(doc[at]), learn, _small(np.array([len(keys)])))))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.binary())], ["bucket", "flush", "data"])

        task = 0
        for batch in batches:
            task = batch.column("task")[0].as_py() if batch.num_rows else task
            texts = texts_of(batch.column("body"))
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(np.uint8)
            for lo, hi in chunks(texts):
                w, h, counts = tokens(texts[lo:hi])
                held.append((w, h, np.repeat(np.arange(hi - lo), counts), keys[lo:hi], train[lo:hi]))
                size += len(w)
                if size >= FLUSH:
                    yield flush(task)
                    held, size, flushes = [], 0, flushes + 1
        if held:
            yield flush(task)
    return cut


_OUT = "kind string, key long, n long, data binary"
#: What a document's sums, and the numbers of a history, are packed as.
_SUMS = ["u"] * (4 + 2 * K) + ["f", "f"]
_HISTORY = ["u"] * (2 + 2 * K)


def _classes(count: np.ndarray, group: np.ndarray, n: int) -> list[np.ndarray]:
    """Per group, how many have count 1, 2, ..., K."""
    return [np.bincount(group[count == r], minlength=n) for r in range(1, K + 1)]


def _count(hot: np.ndarray, hot_counts: np.ndarray, groups: int):
    def count(table: pa.Table) -> pa.Table:
        bucket, out = table.column("bucket")[0].as_py(), []

        def row(kind: str, key: int, n: int = 0, data: bytes | None = None) -> None:
            out.append((kind, int(key), int(n), data))

        if bucket < 0:
            row("docs", table.column("flush")[0].as_py(), 0, table.column("data")[0].as_py())
        else:
            evaluate(table, bucket, row)
        return pa.table({name: pa.array(c, t) for name, c, t in zip(
            ("kind", "key", "n", "data"), zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.binary()))})

    def evaluate(table: pa.Table, bucket: int, row) -> None:
        parts, base, flushes = [], [0], table.column("flush").to_pylist()
        for data in table.column("data").to_pylist():
            wv, runs, hv, hn, dn, learn, docs = _unpack(data, ["u"] * 7)
            w = np.repeat(np.cumsum(wv, dtype=np.uint64), runs)
            parts.append((w, np.cumsum(hv, dtype=np.uint64)[hn], dn.astype(np.int64) + base[-1],
                          np.unpackbits(learn, count=int(docs[0]))))
            base.append(base[-1] + int(docs[0]))
        w, h, doc, train = (np.concatenate(x) for x in zip(*parts))
        del parts
        order = np.lexsort((h, w))
        w, h, doc = w[order], h[order], doc[order]
        learn = train[doc].astype(np.int64)
        new_w = np.concatenate(([True], w[1:] != w[:-1]))
        new = new_w | np.concatenate(([True], h[1:] != h[:-1]))
        first_w, first = np.flatnonzero(new_w), np.flatnonzero(new)
        c_w = np.add.reduceat(learn, first_w)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, w[first_w]), len(hot) - 1)
            is_hot = hot[at] == w[first_w]
            c_w = np.where(is_hot, hot_counts[at], c_w)
        else:
            is_hot = np.zeros(len(c_w), bool)
        c_hw = np.add.reduceat(learn, first)
        of_w, of = np.cumsum(new_w) - 1, np.cumsum(new) - 1
        cw, chw = c_w[of_w], c_hw[of]
        m = base[-1]
        seen = chw > 0
        # documents: classes of the counts that are discounted, what is summed as it is
        log_cw1 = np.log10(cw + 1.0)
        x = np.where(seen & (chw > K), np.log10(np.maximum(chw, 1)), 0.0)
        x += np.where(w == END, log_cw1, 0.0) + np.where(~seen & (cw > K), np.log10(np.maximum(cw, 1)), 0.0)
        fields = [np.bincount(doc, minlength=m), np.bincount(doc[cw > 0], minlength=m), np.bincount(doc[~seen], minlength=m),
                  *_classes(chw, doc, m), *_classes(np.where(seen, 0, cw), doc, m),
                  np.bincount(doc, weights=x, minlength=m), np.bincount(doc, weights=log_cw1, minlength=m)]
        for i, flush in enumerate(flushes):
            cut = [f[base[i]:base[i + 1]] for f in fields]
            met = np.flatnonzero(cut[0])
            row("sums", flush, 0, _pack(_small(np.diff(met, prepend=0)), *[
                f[met] if f.dtype.kind == "f" else _small(f[met]) for f in cut]))
        # tokens that back off, of known histories or not, to the history's group
        off = np.flatnonzero(~seen)
        place = mix(h[off]) % _U(groups)
        for g in np.unique(place).tolist():
            at = off[place == g]
            at = at[np.argsort(h[at], kind="stable")]
            hv, hn = _coded(h[at])
            source = np.searchsorted(base, doc[at], side="right") - 1
            row("event", g, 0, _pack(hv, _small(np.bincount(hn)), np.array(flushes, np.uint64), _small(source),
                                     _small(doc[at] - np.array(base)[source])))
        # unigrams
        mine = (c_w > 0) & ~is_hot
        row("unigram", bucket, c_w[mine].sum(), _pack(np.diff(w[first_w][mine], prepend=_U(0)), _small(c_w[mine])))
        numbers = np.bincount(np.minimum(c_w[mine], K + 2), minlength=K + 3)
        for r in range(1, K + 3):
            row("words", r, numbers[r])
        # histories: numbers of followers by their counts, and by the followers' own counts
        kept = np.flatnonzero(c_hw > 0)
        if len(kept):
            own, follower, hist = c_hw[kept], c_w[of_w[first]][kept], h[first][kept]
            order = np.lexsort((hist, mix(hist) % _U(groups)))
            own, follower, hist = own[order], follower[order], hist[order]
            start = np.flatnonzero(np.concatenate(([True], hist[1:] != hist[:-1])))
            number = np.cumsum(np.concatenate(([False], hist[1:] != hist[:-1])))
            hist, n = hist[start], len(start)
            fields = [*_classes(own, number, n), *_classes(follower, number, n),
                      np.bincount(number, weights=np.where(follower > K, follower, 0), minlength=n).astype(np.int64)]
            place = (mix(hist) % _U(groups)).astype(np.int64)
            edges = np.searchsorted(place, np.arange(groups + 1))
            for g in range(groups):
                cut = slice(edges[g], edges[g + 1])
                if edges[g + 1] > edges[g]:
                    row("history", g, 0, _pack(np.diff(hist[cut], prepend=_U(0)), *[_small(f[cut]) for f in fields]))
            # the bigram table: words, how many histories each has, histories, counts
            own, ww = c_hw[kept], w[first][kept]
            runs = np.diff(np.append(np.flatnonzero(np.concatenate(([True], ww[1:] != ww[:-1]))), len(ww)))
            row("bigram", bucket, len(kept), _pack(np.unique(ww), _small(runs), h[first][kept], _small(own)))
            numbers = np.bincount(np.minimum(own, K + 2), minlength=K + 3)
            for r in range(1, K + 2):
                row("bigrams", r, numbers[r])
    return count


def _summed(keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys and the sums of each array over them."""
    distinct, number = np.unique(keys, return_inverse=True)
    return distinct, [np.bincount(number, weights=v, minlength=len(distinct)) for v in values]


def _weights(met: list[pa.Scalar], d1: list[float], d2: list[float], total: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct histories and log10 a(h) (c(h) + 1) of each."""
    parts = [_unpack(data.as_py(), _HISTORY) for data in met]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0)
    hist, number = np.unique(np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts]), return_inverse=True)

    def field(i: int) -> np.ndarray:
        return np.bincount(number, weights=np.concatenate([x[1 + i] for x in parts]), minlength=len(hist))

    left, under = np.zeros(len(hist)), np.zeros(len(hist))
    for i in range(K):
        left += (1 - d2[i]) * (i + 1) * field(i)
        under += d1[i] * (i + 1) * field(K + i)
    return hist, np.log10((1.0 + left) / (1 - (field(2 * K) + under) / (total + 1)))


def _back(d1: list[float], d2: list[float], total: int):
    """Of one group of histories: log10 a(h) (c(h) + 1), summed over the tokens of a
    document that back off from them."""
    def back(table: pa.Table) -> pa.Table:
        # Numbers stay as narrow as they came until one field at a time is summed.
        met, asked = [], []
        for kind, data in zip(table.column("kind").to_pylist(), table.column("data")):
            (met if kind == "history" else asked).append(data)
        hist, weights = _weights(met, d1, d2, total)
        names, parts = {}, []
        for data in asked:
            hv, runs, flushes, source, doc = _unpack(data.as_py(), ["u"] * 5)
            number = np.array([names.setdefault(f, len(names)) for f in flushes.tolist()], np.uint32)
            h = np.cumsum(hv, dtype=np.uint64)
            weight = np.zeros(len(h))
            if len(hist):
                at = np.minimum(np.searchsorted(hist, h), len(hist) - 1)
                weight = np.where(hist[at] == h, weights[at], 0.0)
            parts.append((number[source], doc, np.repeat(weight, runs)))
        out = []
        if parts:
            flush, doc, weight = (np.concatenate(x) for x in zip(*parts))
            del parts
            for name, i in names.items():
                mine = flush == i
                if mine.any():
                    own, (sums,) = _summed(doc[mine], [weight[mine]])
                    out.append((np.uint64(name).astype(np.int64), _pack(_small(np.diff(own.astype(np.int64), prepend=0)), sums)))
        return pa.table({"kind": pa.array(["back"] * len(out), pa.string()), "key": pa.array([o[0] for o in out], pa.int64()),
                         "data": pa.array([o[1] for o in out], pa.binary())})
    return back


def _gathered(table: pa.Table) -> pa.Table:
    """Of one task's documents: key, whether learnt from, and their sums."""
    parts = list(zip(table.column("kind").to_pylist(), table.column("data").to_pylist()))
    keys, train = next(_unpack(d, ["i", "u"]) for k, d in parts if k == "docs")
    sums = np.zeros((len(_SUMS), len(keys)))  # the last one for what is added by backing off
    for kind, data in parts:
        if kind == "docs":
            continue
        x = _unpack(data, _SUMS if kind == "sums" else ["u", "f"])
        at = np.cumsum(x[0].astype(np.int64))
        if kind == "sums":
            for i, f in enumerate(x[1:]):
                sums[i][at] += f
        else:
            sums[-1][at] += x[1]
    names = ["n_tokens", "n_known", "n_off", *[f"s{i}" for i in range(K)], *[f"u{i}" for i in range(K)]]
    return pa.table({"key": pa.array(keys, pa.int64()), "train": pa.array(train.astype(bool)),
                     **{n: pa.array(sums[i].astype(np.int64)) for i, n in enumerate(names)},
                     "x": pa.array(sums[-3]), "y": pa.array(sums[-2]), "back": pa.array(sums[-1])})


_GATHERED = ("key long, train boolean, n_tokens long, n_known long, n_off long, "
             + ", ".join(f"{c}{i} long" for c in "su" for i in range(K)) + ", x double, y double, back double")


def discounts(n: dict[int, int]) -> list[float]:
    """Good-Turing discounts of counts 1 to K from the numbers of types with
    each count; 1 where those numbers give none."""
    n1, end = n.get(1, 0), n.get(K + 1, 0)
    common = (K + 1) * end / n1 if n1 else 0.0
    out = []
    for r in range(1, K + 1):
        d = 1.0
        if n.get(r, 0) and n1 and common < 1:
            d = ((r + 1) * n.get(r + 1, 0) / (r * n[r]) - common) / (1 - common)
        out.append(d if 0 < d < 1 else 1.0)
    return out


def _hot_words(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Words with more than `HOT` of the tokens of a sample, and their exact
    training counts."""
    def local(batches):
        total: dict = {}
        n = 0
        for batch in batches:
            texts = texts_of(batch.column("body"))
            for lo, hi in chunks(texts):
                w = tokens(texts[lo:hi])[0]
                v, c = np.unique(w, return_counts=True)
                n += len(w)
                keep = c > HOT * len(w) / 4
                for a, b in zip(v[keep].tolist(), c[keep].tolist()):
                    total[a] = total.get(a, 0) + b
        names = [k for k, c in total.items() if c > HOT * n / 2]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array([*names, 0], np.uint64).view(np.int64)), pa.array([*[total[k] for k in names], n])], ["w", "n"])

    sample = rows.where(F.pmod(F.xxhash64("key"), F.lit(SAMPLED)) == 0)
    got = {r.w: r.n for r in sample.select("body").mapInArrow(local, "w long, n long").groupBy("w")
           .agg(F.sum("n").alias("n")).collect()}
    all_ = got.pop(0, 0)
    hot = np.sort(np.array([w for w, n in got.items() if n > HOT * all_], np.int64).view(np.uint64))
    if not len(hot):
        return hot, np.zeros(0, np.int64)

    def exact(batches):
        total = np.zeros(len(hot), np.int64)
        for batch in batches:
            texts = texts_of(batch.column("body"))
            for lo, hi in chunks(texts):
                w = tokens(texts[lo:hi])[0]
                at = np.minimum(np.searchsorted(hot, w), len(hot) - 1)
                total += np.bincount(at[hot[at] == w], minlength=len(hot))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(hot))), pa.array(total)], ["i", "n"])

    counts = np.zeros(len(hot), np.int64)
    for r in rows.where("train").select("body").mapInArrow(exact, "i long, n long").groupBy("i") \
            .agg(F.sum("n").alias("n")).collect():
        counts[r.i] = r.n
    return hot[counts > 0], counts[counts > 0]


def scored(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text",
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document row: `id_col`, held_out, n_tokens, n_known,
    train_tokens, base_score, score; all logarithms to base ten.

    `held_out` says which rows are scored only; the others are learnt from and
    scored too.  Null text is empty: its end alone.  Rows equal in id and text
    count as often as they stand there.  If nothing is learnt from, every token
    is the unknown one.  Further columns are ignored; no rows give no rows.
    """
    spark = prepare(docs.sparkSession, 16 << 20)  # more tokens in a flush, fewer bytes shuffled
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
        (~F.coalesce(held_out, F.lit(False))).alias("train"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)), F.sum(F.col("train").cast("long"))).first()
    buckets = max(1, -(-size[0] // bucket_bytes))
    hot, hot_counts = _hot_words(rows)
    groups = -(-buckets // HISTORY_BUCKETS)
    model = shared_dir(spark, "katz")
    cut = rows.select("body", "key", "train", F.spark_partition_id().alias("task")).mapInArrow(
        _cut(buckets, hot), "bucket long, flush long, data binary")
    # The tokens' shuffle files go as soon as the tables are written, not when the driver collects garbage.
    kept = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        cut.groupBy("bucket").applyInArrow(_count(hot, hot_counts, groups), _OUT) \
            .write.partitionBy("kind").parquet(model)
    finally:
        spark.conf.set(_CLEANUP, kept)
    # every kind may be missing if there is nothing of it
    stored = spark.read.schema(_OUT).parquet(model)

    def kind(*names: str) -> DataFrame:
        return stored.where(F.col("kind").isin(*names))

    n, n2 = ({r.key: r.n for r in kind(name).groupBy("key").agg(F.sum("n").alias("n")).collect()} for name in ("words", "bigrams"))
    for c in hot_counts.tolist():  # counted apart
        n[min(c, K + 2)] = n.get(min(c, K + 2), 0) + 1
    total = int(kind("unigram").agg(F.sum("n")).first()[0] or 0) + int(hot_counts.sum())
    types = sum(n.values())
    d1, d2 = discounts(n), discounts(n2)
    lost = 1 + sum((1 - d) * r * n.get(r, 0) for r, d in enumerate(d1, 1))  # of N + 1, for the unknown word
    off = kind("history", "event").select("kind", "key", "data").groupBy("key").applyInArrow(
        _back(d1, d2, total), "kind string, key long, data binary")
    doc = kind("docs", "sums").select("kind", "key", "data").unionByName(off).groupBy("key").applyInArrow(_gathered, _GATHERED)
    # log10(c(h) + 1) of a token's history is that of the token before it, the end's aside
    unknown = F.col("n_tokens") - F.col("n_known")
    score = F.col("x") - F.col("y") + F.col("back") - F.col("n_off") * math.log10(total + 1) + unknown * math.log10(lost)
    for i in range(K):
        score = score + F.col(f"s{i}") * math.log10(d2[i] * (i + 1)) + F.col(f"u{i}") * math.log10(d1[i] * (i + 1))
    doc = doc.select("key", "n_tokens", "n_known",
                     (F.col("y") - F.col("n_tokens") * math.log10(total + types + 1)).alias("base"), score.alias("score"))
    # rows equal in id and text have equal sums
    doc = doc.groupBy("key").agg(*[F.first(c).alias(c) for c in doc.columns[1:]])
    start = math.log10((size[1] or 0) + 1)
    named = rows.select("id", "key", (~F.col("train")).alias("held_out"))
    return named.join(doc, "key").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("score") - start).alias("score"))
