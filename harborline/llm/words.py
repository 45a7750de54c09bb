"""Whole texts as byte buffers: word spans and 64-bit word hashes with numpy.

Texts reach a task as Arrow batches.  They are joined to one buffer with a
separator between documents, so words of thousands of documents are found,
hashed and counted by a few vectorised passes.  Every separator class used
here is ASCII, hence working on UTF-8 bytes equals working on characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at a time; a longer document is a chunk of its own.
CHUNK_BYTES = 2 << 20

SPACES = (0x20, *range(0x09, 0x0E))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: ASCII bytes other than digits and letters.
IS_MARK = np.zeros(256, bool)
IS_MARK[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

_K = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xFF51AFD7ED558CCD)
_C = np.uint64(0xC4CEB9FE1A85EC53)
_TAIL = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [0xFFFFFFFFFFFFFFFF], np.uint64)
_LONG = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * _M
    x = (x ^ (x >> np.uint64(33))) * _C
    return x ^ (x >> np.uint64(33))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-dependent hash of two hashes."""
    return mix((a * _K) ^ mix(b + _K))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The column's texts as bytes; null is the empty text."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about `most` bytes."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def buffer(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of the texts, a separator after each and eight bytes of
    room at the end, and where each text starts (with the end of the last)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n" * 9, np.uint8)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=starts[1:])
    return (LOWER[buf] if lower else buf), starts


def spans(buf: np.ndarray, doc_starts: np.ndarray, separators: np.ndarray = IS_SPACE):
    """Start and length of every word, and how many words each document has."""
    inside = ~separators[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    bounds = np.searchsorted(starts, doc_starts)
    return starts, ends - starts, np.diff(bounds)


def hash_spans(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans.  Eight bytes a round; spans of over 256
    bytes get a cryptographic digest each."""
    wide = np.ndarray((len(buf) - 7,), "<u8", buffer=np.ascontiguousarray(buf), strides=(1,))
    out = lengths.astype(np.uint64) * _K
    if not len(starts):
        return out
    short = np.minimum(lengths, 8)
    out = mix(out ^ (wide[starts] & _TAIL[short]))
    todo, at = np.flatnonzero((lengths > 8) & (lengths <= _LONG)), 8
    while len(todo):
        rest = np.minimum(lengths[todo] - at, 8)
        out[todo] = mix(out[todo] * _K ^ (wide[starts[todo] + at] & _TAIL[rest]))
        at += 8
        todo = todo[lengths[todo] > at]
    for i in np.flatnonzero(lengths > _LONG):
        s = starts[i]
        digest = hashlib.blake2b(buf[s:s + lengths[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, "<u8")[0]
    return out


def word_hashes(texts: list[bytes], separators: np.ndarray = IS_SPACE):
    """Hashes of the lower-cased words of all texts, in order, and the number
    of words of each text."""
    buf, at = buffer(texts)
    starts, lengths, counts = spans(buf, at, separators)
    return hash_spans(buf, starts, lengths), counts
