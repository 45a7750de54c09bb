"""Bound-certified best-fit packing of token pieces into fixed-length sequences.

Pieces are dealt by a hash to partitions of bounded size.  Each is packed by
best-fit decreasing and its number of sequences held against a lower bound from
dual feasible functions: a partition that meets its bound is certified.  The
partly filled sequences of the others go into a pool that is dealt anew, so
partitions with gaps exchange documents, and packed again, as long as that
saves sequences.  What remains of certified partitions is one open sequence
each; those are pooled in the same way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from harborline.llm.encode import encoder, with_end
from harborline.llm.words import texts_of
from harborline.llm.runtime import lean, prepare
from harborline.session import materialize

CAPACITY = 1024
END = 2
#: Pieces in a partition, about.
GROUP = 40_000
ROUNDS = 3


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: bin and offset of every piece, number of bins.

    Open bins are kept by free room; a bit per room tells which have bins, so
    the tightest one is found by one shift.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, used = 0, 0
    order = np.argsort(-sizes, kind="stable")
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            b, room = used, capacity
            used += 1
        bins[i], offsets[i] = b, capacity - room
        if room > size:
            rooms[room - size].append(b)
            mask |= 1 << (room - size)
    return bins, offsets, used


def lower_bound(sizes: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing has fewer bins: the best of three families of dual feasible
    functions over all their parameters (Fekete and Schepers, 2001)."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    s = np.arange(capacity + 1)
    best = -(-int(count @ s) // capacity)
    for k in range(1, 40):  # u(k): rounds to k steps; exact multiples keep their size
        exact = (s * (k + 1)) % capacity == 0
        # scaled by k * capacity, so that everything stays whole
        f = np.where(exact, s * k, ((k + 1) * s // capacity) * capacity)
        best = max(best, -(-int(count @ f) // (k * capacity)))
    for e in range(0, capacity // 2 + 1):  # U(e): large become whole, small vanish
        f = np.where(s > capacity - e, capacity, np.where(s >= e, s, 0))
        best = max(best, -(-int(count @ f) // capacity))
    for e in range(1, capacity // 2 + 1):  # phi(e): sizes in units of e
        unit = capacity // e
        f = np.where(2 * s > capacity, 2 * (unit - (capacity - s) // e),
                     np.where(2 * s == capacity, unit, 2 * (s // e)))
        f = np.where(s == 0, 0, f)
        best = max(best, -(-int(count @ f) // (2 * unit)))
    return best


def pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
           end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: uid (unique), id, piece, start, length, ids_crc32.
    Only a document of more than `capacity` ids has several; its first piece
    takes what the whole ones leave over."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    kind = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer, "spaced")
        uid = TaskContext.get().partitionId() << 38
        for batch in batches:
            texts = texts_of(batch.column("body"))
            for lo, hi, ids, bounds in tool.encode(texts):
                ids, bounds = with_end(ids, bounds, end)
                size = np.diff(bounds)
                n = -(-size // capacity)
                doc = np.repeat(np.arange(hi - lo), n)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                head = size - (n - 1) * capacity
                start = np.where(number == 0, 0, head[doc] + (number - 1) * capacity)
                length = np.where(number == 0, head[doc], capacity)
                raw, base = memoryview(ids.astype("<u4").tobytes()), bounds[doc] + start
                crc = [zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip(base.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid + np.arange(len(doc))), batch.column("id").take(pa.array(lo + doc)),
                     pa.array(number.astype(np.int32)), pa.array(start), pa.array(length),
                     pa.array(crc, pa.int64())], ["uid", "id", "piece", "start", "length", "ids_crc32"])
                uid += len(doc)

    return rows.mapInArrow(lean(cut, (tokenizer, "spaced")), f"uid long, id {kind}, piece int, start long, length long, ids_crc32 long")


_PLACED = "uid long, length long, sequence_id long, offset long, filled long, bound long, bins long"


def _packer(round_: int, capacity: int):
    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid", ignore_index=True)
        sizes = frame["length"].to_numpy()
        bins, offsets, used = best_fit(sizes, capacity)
        filled = np.bincount(bins, weights=sizes, minlength=used).astype(np.int64)
        return pd.DataFrame({
            "uid": frame["uid"], "length": sizes,
            "sequence_id": (round_ << 58) + (int(key[0]) << 28) + bins, "offset": offsets,
            "filled": filled[bins], "bound": lower_bound(sizes, capacity), "bins": used})
    return pack


def pack(rows: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP,
         rounds: int = ROUNDS) -> DataFrame:
    """uid, sequence_id, offset for every row of `rows` (uid, length, both
    whole numbers; uid unique, length 1 to `capacity`).

    Full pieces are sequences of their own.  Every other group holds about
    `group` rows whatever the data, as uids are unique.  Sequences are gapless
    from offset 0.  No rows give no rows.
    """
    full = rows.where(F.col("length") >= capacity).select(
        "uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo, settled = rows.where(F.col("length") < capacity).select("uid", "length"), full
    best = None
    for round_ in range(rounds):
        n = todo.count()
        if not n:
            return settled
        groups = max(1, round(n / group))
        dealt = todo.withColumn("g", F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(groups)))
        placed = materialize(dealt.groupBy("g").applyInPandas(_packer(round_, capacity), _PLACED), "packed")
        # A sequence opens for exchange unless it is full, or its partition is
        # certified and it is not the least filled there.
        used = placed.where("offset = 0").agg(F.count("*")).first()[0]
        if best is not None and used >= best[1]:
            return settled.union(best[0].select("uid", "sequence_id", "offset"))
        gap = F.col("bins") > F.col("bound")
        part = F.shiftright("sequence_id", 28)
        least = placed.groupBy(part.alias("p")).agg(F.min("filled").alias("low"))
        open_ = placed.withColumn("p", part).join(least, "p").withColumn(
            "open", (F.col("filled") < capacity) & (gap | (F.col("filled") == F.col("low"))))
        if groups == 1 or round_ == rounds - 1:
            return settled.union(placed.select("uid", "sequence_id", "offset"))
        shut, todo = open_.where("not open"), open_.where("open")
        best = (todo, todo.where("offset = 0").agg(F.count("*")).first()[0])
        settled = settled.union(shut.select("uid", "sequence_id", "offset"))
        todo = todo.select("uid", "length")
    return settled


def packed_documents(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id",
                     text_col: str = "text", capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """One row per piece of every document row: `id_col`, piece, start, length,
    ids_crc32, sequence_id, offset.

    A null or empty text is one piece, its end id.  Repeated rows are packed
    like others.  Further columns are ignored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    cut = materialize(pieces(docs, tokenizer, id_col=id_col, text_col=text_col, capacity=capacity), "pieces")
    placed = pack(cut.select("uid", "length"), capacity=capacity, group=group)
    return cut.join(placed, "uid").select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
