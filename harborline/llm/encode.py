"""Token ids of whole texts by a public tokenizer, each distinct piece encoded once.

Both tokenizers split a text before they merge, so a text may be cut where the
split always falls and the pieces encoded on their own:

* "words": at ASCII white space, for tokenizers that drop white space;
* "spaced": before a blank followed by a character that is surely not white
  space, for byte-level ones that join one blank to the word behind it.

A worker keeps the ids of the pieces it has met, keyed by 64-bit hashes (about one
million pieces or eight million ids, then it starts anew; a false match has a probability of
about 1e-7 per worker), and looks up all pieces of a buffer at once.

A text that spells out an added token such as <|endoftext|> gets its id, as by
the plain call; it is encoded whole, as blanks before the token depend on it.
"""

from __future__ import annotations

import itertools
import os

import numpy as np

from harborline.llm.runtime import kept
from harborline.llm.words import IS_SPACE, buffer, chunks, hash_spans, spans

#: Pieces, and ids of pieces, from which on a worker starts anew.
_FULL, _IDS = 1 << 20, 1 << 23
#: Bits of a slot's number at first.  Tables are at most half full and double.
_BITS = 16
_TOGETHER = 32
#: Bytes of text looked up at a time, and pieces that are strings and lists at a time.
_BYTES = 1 << 19
_SLICE = 1 << 13

# First bytes of characters that are not white space: printable ASCII and lead
# bytes other than those under which Unicode has white space (C2, E1, E2, E3).
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xF5] = True
_SOLID[[0xE1, 0xE2, 0xE3]] = False


class Encoder:
    """Ids of many texts; one per worker and tokenizer, see `encoder`."""

    def __init__(self, path: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode() for t in added]
        self.words = pieces == "words"
        self.mark = self._encode([" \x01"])[0]
        self._reset()

    def _reset(self):
        self._slots(_BITS)
        self.n, self.used = 0, 0
        self.first, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.pool = np.zeros(1 << 18, np.int32)

    def _slots(self, bits: int):
        self.bits = bits
        self.keys = np.zeros(1 << bits, np.uint64)
        self.at = np.full(1 << bits, -1, np.int32)

    def _room(self, n: int):
        """Slots for `n` pieces; known ones keep their numbers."""
        bits = max(self.bits, (2 * n - 1).bit_length())
        if bits > self.bits:
            used = np.flatnonzero(self.at >= 0)
            known = self.keys[used[np.argsort(self.at[used])]]
            self._slots(bits)
            self.n = 0
            self._find(known, add=True)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _find(self, h: np.ndarray, add: bool = False) -> np.ndarray:
        """Piece numbers of hashes, -1 if unknown; `add` gives hashes, all
        distinct and unknown, the next numbers in order."""
        out = np.full(len(h), -1, np.int32)
        todo = np.arange(len(h))
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(todo):
            s = slot[todo]
            have = self.at[s]
            same = (have >= 0) & (self.keys[s] == h[todo])
            out[todo[same]] = have[same]
            empty = have < 0
            if add:
                _, one = np.unique(s[empty], return_index=True)
                new, place = todo[empty][one], s[empty][one]
                self.keys[place], self.at[place], out[new] = h[new], self.n + new, self.n + new
                lost = np.ones(int(empty.sum()), bool)
                lost[one] = False
                again = np.concatenate((todo[~same & ~empty], todo[empty][lost]))
            else:
                again = todo[~same & ~empty]
            slot[again] = (slot[again] + 1) & (len(self.keys) - 1)
            todo = again
        if add:
            self.n += len(h)
        return out

    def _ids_of(self, texts: list[str]) -> list[list[int]]:
        """Ids of pieces.  Short ones are encoded many at a time with a control
        character between them, as each call has a price."""
        out: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if len(t) < 64 and "\x01" not in t
                 and (self.words or t[0] == " ")]
        lead = " " if self.words else ""
        groups = [plain[i:i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        joined = self._encode([" \x01".join(lead + texts[i] for i in g) for g in groups])
        end, gap = self.mark[-1], len(self.mark) - 1
        for group, ids in zip(groups, joined):
            cuts = [i for i, x in enumerate(ids) if x == end]
            lo = 0
            for i, cut in zip(group, [*cuts, len(ids) + gap]):
                out[i] = ids[lo:cut - gap]
                lo = cut + 1
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._encode([texts[i] for i in rest])):
            out[i] = ids
        return out

    def _learn(self, buf, starts, lengths, h):
        """Encodes the distinct pieces, some at a time: strings and lists of
        numbers take many times the bytes of what is kept."""
        _, one = np.unique(h, return_index=True)
        h, starts, lengths = h[one], starts[one], lengths[one]
        self._room(self.n + len(h))
        number = self._find(h, add=True)
        while self.n > len(self.first):
            self.first = np.concatenate((self.first, np.zeros_like(self.first)))
            self.length = np.concatenate((self.length, np.zeros_like(self.length)))
        for i in range(0, len(h), _SLICE):
            got = self._ids_of([buf[s:s + n].tobytes().decode("utf-8")
                                for s, n in zip(starts[i:i + _SLICE].tolist(), lengths[i:i + _SLICE].tolist())])
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter(itertools.chain.from_iterable(got), np.int32, int(sizes.sum()))
            while self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
            self.pool[self.used:self.used + len(flat)] = flat
            self.first[number[i:i + _SLICE]] = self.used + np.concatenate(([0], np.cumsum(sizes)[:-1]))
            self.length[number[i:i + _SLICE]] = sizes
            self.used += len(flat)

    def _pieces(self, buf: np.ndarray, at: np.ndarray):
        if self.words:
            return spans(buf, at, IS_SPACE)
        flag = np.zeros(len(buf), bool)
        flag[:-1] = (buf[:-1] == 0x20) & _SOLID[buf[1:]]
        flag[at[:-1][np.diff(at) > 1]] = True
        starts = np.flatnonzero(flag)
        bounds = np.searchsorted(starts, at)
        ends = np.append(starts[1:], at[-1])[:len(starts)]
        doc = np.repeat(np.arange(len(at) - 1), np.diff(bounds))
        return starts, np.minimum(ends, at[doc + 1] - 1) - starts, np.diff(bounds)

    def encode(self, texts: list[bytes]):
        """Yields (first, last, ids, bounds) for runs of texts: all their ids
        in one array, and where each text's ids begin (with the end of the last)."""
        lo = 0
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        for i in [*whole, len(texts)]:
            for first, last, ids, bounds in self._encode_pieces(texts[lo:i]):
                yield lo + first, lo + last, ids, bounds
            if i < len(texts):
                ids = np.array(self._encode([texts[i].decode("utf-8")])[0], np.int32)
                yield i, i + 1, ids, np.array([0, len(ids)])
            lo = i + 1

    def _encode_pieces(self, texts: list[bytes]):
        for lo, hi in chunks(texts, _BYTES):
            buf, at = buffer(texts[lo:hi], lower=False)
            starts, lengths, counts = self._pieces(buf, at)
            h = hash_spans(buf, starts, lengths)
            number = self._find(h)
            new = number < 0
            if new.any():
                if self.n + int(new.sum()) > _FULL or self.used > _IDS:
                    self._reset()
                    new[:] = True
                self._learn(buf, starts[new], lengths[new], h[new])
                number = self._find(h)
            size = self.length[number].astype(np.int64)
            total = np.concatenate(([0], np.cumsum(size)))
            where = np.repeat(self.first[number] - total[:-1], size) + np.arange(total[-1])
            bounds = total[np.concatenate(([0], np.cumsum(counts)))]
            yield lo, hi, self.pool[where], bounds


def encoder(path: str, pieces: str) -> Encoder:
    return kept((path, pieces), lambda: Encoder(path, pieces))


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with id `end` after each text."""
    n = len(bounds) - 1
    out = np.empty(len(ids) + n, np.uint32)
    stops = bounds[1:] + np.arange(n)
    mask = np.ones(len(out), bool)
    mask[stops] = False
    out[stops] = end
    out[mask] = ids
    return out, bounds + np.arange(n + 1)
