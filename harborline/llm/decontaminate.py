"""Benchmark decontamination by one Aho-Corasick automaton over word windows.

Text and items are normalised alike: A-Z lower-cased, words are runs of
letters, digits and all characters beyond ASCII.  A pattern is a window of 13
consecutive item words, or the whole item if it has fewer.  Words become small
integers (0: in no item) and the automaton runs over those, once per document;
its hits are word positions, mapped back to character offsets of the original.

Benchmarks are small next to a corpus, but their size is checked: items are
dealt into blocks of about `block_bytes` of text by a hash of it, as an automaton
takes some 120 bytes a byte of items (measured: 4 MB take 0.5 GB) in each Python
worker.  One block, the usual case, means one automaton and one pass; more
blocks mean one pass each, which adds to the items and words found.  Items with
the same words are one, whatever their number.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from harborline.llm.words import IS_MARK, LOWER
from harborline.llm.runtime import kept, lean, prepare

WINDOW = 13
#: Item text of one automaton: about a quarter of a gigabyte.
BLOCK_BYTES = 2 << 20

_NORMAL = bytes(0x20 if IS_MARK[LOWER[b]] else LOWER[b] for b in range(256))

SCHEMA = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "hit_spans array<struct<start: long, end: long>>")


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class _Machine:
    """Vocabulary and automaton of one block."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        alike: dict[tuple, list[str]] = {}
        for item, text in items:
            ids = tuple([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in normal_words(text)])
            if ids:
                alike.setdefault(ids, []).append(item)
        self.items = list(alike.values())
        self.lengths: list[int] = []
        self.groups: list[list[int]] = []  # per pattern, which of `items`
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for group, ids in enumerate(alike):
            for i in range(max(1, len(ids) - window + 1)):
                pattern = ids[i:i + window]
                number = self.machine.get(pattern, -1)
                if number < 0:
                    number = len(self.lengths)
                    self.machine.add_word(pattern, number)
                    self.lengths.append(len(pattern))
                    self.groups.append([])
                if not self.groups[number] or self.groups[number][-1] != group:
                    self.groups[number].append(group)
        if self.lengths:
            self.machine.make_automaton()

    def find(self, text: bytes) -> tuple[int, set[str], list[tuple[int, int]]]:
        """Number of words, items with windows in the text, runs of hit words."""
        words = normal_words(text)
        runs: list[tuple[int, int]] = []
        if not self.lengths or not words:
            return len(words), set(), runs
        get = self.vocabulary.get
        numbers = set()
        for last, number in self.machine.iter(tuple([get(w, 0) for w in words])):
            numbers.add(number)
            first = last - self.lengths[number] + 1
            while runs and first <= runs[-1][1] + 1:  # ends come in order
                first = min(first, runs.pop()[0])
            runs.append((first, last))
        groups = {g for n in numbers for g in self.groups[n]}
        return len(words), {item for g in groups for item in self.items[g]}, runs


def _char_spans(text: bytes, mask: np.ndarray) -> list[dict]:
    """Runs of hit words as character offsets of the original text."""
    flat = np.frombuffer(text.translate(_NORMAL), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flat, [False])).astype(np.int8)))
    # characters before each byte: bytes that do not continue a character
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    runs = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return [{"start": int(chars[edge[2 * a]]), "end": int(chars[edge[2 * b - 1]])}
            for a, b in zip(runs[0::2], runs[1::2])]


def contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  keep: list[str] | None = None) -> DataFrame:
    """One row per document row: `keep` columns (default: the id), n_words, n_hit (words inside an
    occurrence of a window), n_items, items_sha256, contaminated (n_hit > 0
    and 20 * n_hit >= n_words) and hit_spans (runs of hit words as character
    offsets, end exclusive).

    A null text has no words and no hits; repeated rows give repeated rows.
    Items with null id or without words have no windows; rows of one item id
    add up.  No items: nothing is contaminated.  Further columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    items = items.select(F.col(item_col).cast("string").alias("item"),
                         F.col(item_text).cast("binary").alias("body")).dropna()
    size = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    names = keep or [id_col]
    # A text among the kept columns passes through Python once.
    body = f"k{names.index(text_col)}" if text_col in names else "body"
    out = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(names)],
                      *([] if body != "body" else [F.col(text_col).alias("body")]))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema if f.name != "body")
    hits_type = "struct<items: array<string>, runs: array<struct<first: long, last: long>>>"
    for b in range(blocks):
        part = items.where(F.pmod(F.crc32("body"), F.lit(blocks)) == b)
        sent = spark.sparkContext.broadcast([(r.item, bytes(r.body)) for r in part.collect()])
        last = b == blocks - 1
        scan = _scanner(sent, uuid.uuid4().hex, window, last, body)
        out = out.mapInArrow(scan, f"{kept}, " + (
            SCHEMA if last else ("body string, " if body == "body" else "") + f"hits {hits_type}"))
    return out.withColumnsRenamed({f"k{i}": c for i, c in enumerate(names)})


def _scanner(sent, key: str, window: int, last: bool, body: str):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    state = pa.struct([("items", pa.list_(pa.string())), ("runs", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = kept(key, lambda: _Machine(sent.value, window))
        for batch in batches:
            texts = batch.column(body).cast(pa.large_binary()).to_pylist()
            before = batch.column("hits").to_pylist() if "hits" in batch.schema.names else [None] * len(texts)
            passed = [c for c in batch.schema.names if c not in ("body", "hits")]
            rest = [batch.column(c) for c in passed]
            found = []
            for text, old in zip(texts, before):
                n, items, runs = machine.find(text or b"")
                if old:
                    items |= set(old["items"])
                    runs += [(r["first"], r["last"]) for r in old["runs"]]
                found.append((n, items, runs))
            if last:
                rows = [_result(t or b"", *f) for t, f in zip(texts, found)]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), span]
                yield pa.RecordBatch.from_arrays(
                    [*rest, *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]],
                    [*passed, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans"])
            else:
                more = [] if body != "body" else ["body"]
                hits = [{"items": sorted(i), "runs": [{"first": a, "last": z} for a, z in r]} for _, i, r in found]
                yield pa.RecordBatch.from_arrays([*rest, *map(batch.column, more), pa.array(hits, state)], [*passed, *more, "hits"])

    return lean(scan, key)


_NONE = hashlib.sha256(b"").hexdigest()


def _result(text: bytes, n_words: int, items: set[str], runs: list[tuple[int, int]]) -> tuple:
    if not runs:
        return n_words, 0, 0, _NONE, False, []
    step = np.zeros(n_words + 1, np.int64)
    for first, last in runs:
        step[first] += 1
        step[last + 1] -= 1
    mask = np.cumsum(step[:-1]) > 0
    n_hit = int(mask.sum())
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return n_words, n_hit, len(items), digest, 20 * n_hit >= n_words, _char_spans(text, mask)
