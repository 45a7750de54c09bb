"""Token shards as wavelet matrices: succinct bit-planes with rank and select.

A shard holds the ids of documents that follow each other by id.  Its file is
one binary value: a header, where each document starts, and one bit-plane per
id bit.  In plane k stand the k-th highest bits, in the order that a stable
partition by all higher bits leaves.  Ranks come from byte-wise running counts
per block.  Planes and starts are compressed one by one, so counting an id
touches each plane once and nothing else.

File: b"WMX1", then little-endian uint32: tokens, documents, bits, and the
compressed sizes of starts and of each plane; then those parts (zstd).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

from pyspark.sql import DataFrame, functions as F

from harborline.llm.encode import encoder, with_end
from harborline.llm.words import texts_of
from harborline.llm.runtime import prepare
from harborline.session import shared_dir

END = 2
#: Text bytes in a shard, about, and the most ids that one file holds.
SHARD_BYTES = 12 << 20
SHARD_IDS = 8 << 20

_MAGIC = b"WMX1"
_BLOCK = 64
_ONES = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def pack_ids(ids: np.ndarray, bounds: np.ndarray) -> bytes:
    """The file of `ids`; `bounds`: where each document starts, and the end."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    press = zstandard.ZstdCompressor(level=1)
    parts = [press.compress(bounds.astype("<u8").tobytes())]
    now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    for k in range(bits - 1, -1, -1):
        one = (now & now.dtype.type(1 << k)) != 0
        parts.append(press.compress(np.packbits(one, bitorder="little").tobytes()))
        if k:
            now = np.concatenate((now[~one], now[one]))
    head = struct.pack(f"<4s3I{len(parts)}I", _MAGIC, len(ids), len(bounds) - 1, bits, *map(len, parts))
    return head + b"".join(parts)


class Shard:
    """A file read back.  Planes are decompressed when first used."""

    def __init__(self, data: bytes):
        magic, self.n, self.docs, self.bits = struct.unpack_from("<4s3I", data)
        if magic != _MAGIC:
            raise ValueError("not a wavelet shard")
        sizes = struct.unpack_from(f"<{self.bits + 1}I", data, 16)
        at = 16 + 4 * len(sizes)
        self._parts = []
        for size in sizes:
            self._parts.append(data[at:at + size])
            at += size
        self._planes: dict[int, tuple] = {}
        self.bounds = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._parts[0]), "<u8").astype(np.int64)

    def _plane(self, k: int):
        """Bytes of plane k, ones before each block of bytes, number of zeros."""
        if k not in self._planes:
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(
                self._parts[k + 1], max_output_size=self.n // 8 + 1), np.uint8)
            blocks = np.add.reduceat(_ONES[raw], np.arange(0, len(raw), _BLOCK), dtype=np.int64) \
                if len(raw) else np.zeros(0, np.int64)
            before = np.concatenate(([0], np.cumsum(blocks)))
            self._planes[k] = raw, before, self.n - int(before[-1])
        return self._planes[k]

    def _rank1(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k."""
        raw, before, _ = self._plane(k)
        byte, block = i >> 3, (i >> 3) // _BLOCK
        total = int(before[block]) + int(_ONES[raw[block * _BLOCK:byte]].sum())
        if i & 7:
            total += int(_ONES[raw[byte] & ((1 << (i & 7)) - 1)])
        return total

    def _select(self, k: int, bit: int, j: int) -> int:
        """Position of the j-th (from 0) bit of that value in plane k."""
        raw, before, _ = self._plane(k)
        if not bit:
            before = np.minimum(np.arange(len(before)) * _BLOCK * 8, self.n) - before
        block = int(np.searchsorted(before, j, "right")) - 1
        bits = np.unpackbits(raw[block * _BLOCK:(block + 1) * _BLOCK], bitorder="little")
        return block * _BLOCK * 8 + int(np.flatnonzero(bits == bit)[j - int(before[block])])

    def access(self, i: int) -> int:
        """The id at position i."""
        value = 0
        for k in range(self.bits):
            raw, _, zeros = self._plane(k)
            bit = int(raw[i >> 3]) >> (i & 7) & 1
            ones = self._rank1(k, i)
            i = zeros + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.bits:
            return 0, 0
        for k in range(self.bits):
            a, b = self._rank1(k, lo), self._rank1(k, hi)
            zeros = self._plane(k)[2]
            lo, hi = (zeros + a, zeros + b) if token >> (self.bits - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id among positions lo to hi."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def locate(self, token: int, j: int) -> int:
        """Position of the j-th occurrence (from 0) of an id."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= j < b - a:
            raise IndexError(j)
        i = a + j
        for k in range(self.bits - 1, -1, -1):
            zeros = self._plane(k)[2]
            bit = token >> (self.bits - 1 - k) & 1
            i = self._select(k, bit, i - zeros if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids in order: the partitions are undone from the last plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for k in range(self.bits - 1, -1, -1):
            raw, _, zeros = self._plane(k)
            one = np.unpackbits(raw, count=self.n, bitorder="little").view(bool)
            here = np.empty(self.n, kind)
            here[~one] = now[:zeros]
            here[one] = now[zeros:] | kind(1 << (self.bits - 1 - k))
            now = here
        return now


def write_shards(docs: DataFrame, path: str, tokenizer: str, *, pieces: str = "words",
                 id_col: str = "doc_id", text_col: str = "text", end: int = END,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the ids of all documents, `end` after each, as shards and returns
    the written table: part, number, first_id, last_id, ids (tokens), file.

    Documents are dealt to parts by ranges of id (Spark samples them), so part
    and number give the order of the whole.  A part becomes several files once
    it has too many ids; a document is never split.  Rows without id come
    first.  Null text: the end id alone.  Rows that repeat an id stay, next to
    each other.  An empty table gives an empty one.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    parts = max(1, -(-size // shard_bytes))
    kind = rows.schema["id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool, part, number = encoder(tokenizer, pieces), TaskContext.get().partitionId(), 0
        held, names, count = [], [], 0

        def flush():
            nonlocal held, names, count, number
            ids = np.concatenate([x for x, _ in held])
            sizes = np.concatenate([np.diff(b) for _, b in held])
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            known = [x for x in names if x is not None]
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                 pa.array(known[:1] or [None], id_arrow), pa.array(known[-1:] or [None], id_arrow),
                 pa.array([pa.array(names, id_arrow)], pa.list_(id_arrow)), pa.array([len(ids)], pa.int64()),
                 pa.array([pack_ids(ids, bounds)], pa.binary())],
                ["part", "number", "first_id", "last_id", "doc_ids", "ids", "file"])
            held, names, count = [], [], 0
            number += 1
            return out

        for batch in batches:
            id_arrow = batch.column("id").type
            for lo, hi, ids, bounds in tool.encode(texts_of(batch.column("body"))):
                held.append(with_end(ids, bounds, end))
                names += batch.column("id").slice(lo, hi - lo).to_pylist()
                count += len(held[-1][0])
                if count >= SHARD_IDS:
                    yield flush()
        if held:
            yield flush()

    made = rows.repartitionByRange(parts, "id").sortWithinPartitions("id").mapInArrow(
        build, f"part int, number int, first_id {kind}, last_id {kind}, doc_ids array<{kind}>, ids long, file binary")
    made.write.option("compression", "none").parquet(path)
    return spark.read.parquet(path)


def read_documents(shards: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """From the files: `id_col`, start (ids of all documents before it),
    n_tokens and ids_crc32 of every document.

    What each file holds is known from its thin columns, so the ids before a
    file are a running sum over one row per file.
    """
    spark = shards.sparkSession
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    before, total = [], 0
    for r in shards.select("part", "number", "ids").orderBy("part", "number").collect():
        before.append((r.part, r.number, total))
        total += r.ids
    base = spark.createDataFrame(before, "part int, number int, base long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, start, file in zip(batch.column("doc_ids"), batch.column("base").to_pylist(),
                                          batch.column("file").to_pylist()):
                shard = Shard(file)
                raw = memoryview(shard.ids().astype("<u4").tobytes())
                b = shard.bounds
                crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(b[:-1].tolist(), b[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [names.values, pa.array(start + b[:-1]), pa.array(np.diff(b)), pa.array(crc, pa.int64())],
                    ["id", "start", "n_tokens", "ids_crc32"])

    return (shards.join(F.broadcast(base), ["part", "number"]).select("doc_ids", "base", "file")
            .mapInArrow(read, f"id {kind}, start long, n_tokens long, ids_crc32 long")
            .withColumnRenamed("id", id_col))


def encoded_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write shards to the shared folder, read every document back."""
    prepare(docs.sparkSession)
    path = shared_dir(docs.sparkSession, "shards")
    return read_documents(write_shards(docs, path, tokenizer, **options),
                          id_col=options.get("id_col", "doc_id"))
