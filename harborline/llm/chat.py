"""Chat formatting in budgeted windows.

Turns of a conversation become windows of at most `budget` tokens, cut between
turns.  Prefix sums of turn tokens choose how many new turns a window takes:
the system turn (a leading one) opens every window, then come up to `history`
tokens of turns repeated from before, then new turns.  A window takes at least
one new turn; repeated turns give way to it.  A system turn over half the budget is
whole in the first window only; later ones repeat its first quarter budget and a mark.  The loss covers the assistant
texts among the new turns, so each assistant text is a target once, however
often it is repeated as context.

Template: `<|role|>\\n` text `<|end|>\\n`.  Inside texts a backslash is put into
every control string of this and of two common templates, behind its first
character and any backslashes there; taking one out restores the text.  Roles
have their few special characters percent-coded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from harborline.llm.runtime import prepare
from harborline.session import shared_dir

#: Tokens (runs of non-space characters, and one mark per turn) in a window.
BUDGET = 1024
HISTORY = 256

SYSTEM, TARGET = "system", "assistant"
_CONTROL = re.compile(r"([<\[])(\\*)(?=\||/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=\||/?s>|/?INST\])")
_TURN = re.compile(r"<\|([^|]*)\|>\n(.*?)<\|end\|>\n", re.S)
_ROLE = re.compile(r"[%|<>\n]")
_CODED = re.compile(r"%([0-9a-f]{2})")
_WORD = re.compile(r"\S+")

WINDOW_SCHEMA = ("conv_id {kind}, window int, first_turn long, new_turns int, text string, "
                 "loss array<struct<start: long, end: long>>")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    return _ROLE.sub(lambda m: f"%{ord(m[0]):02x}", role)


def unescape_role(role: str) -> str:
    return _CODED.sub(lambda m: chr(int(m[1], 16)), role)


def turn_tokens(text: str) -> int:
    return sum(1 for _ in _WORD.finditer(text)) + 1


def shortened(text: str, tokens: int) -> str:
    """The first `tokens` tokens of a text and a mark."""
    end = 0
    for m in islice(_WORD.finditer(text), tokens):
        end = m.end()
    return text[:end] + " [...]"


class Windows:
    """Windows of one conversation, fed turn by turn.

    `sums[i]` is the number of tokens before held turn i; the cost of any span
    is a difference of two.  Only turns that can still be history are held.
    """

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple | None = None
        self.again: tuple | None = None  # the system turn as later windows repeat it
        self.turns: list[tuple[str, str]] = []
        self.sums = [0]
        self.new = 0  # first held turn that is not in a window yet
        self.seen = self.done = self.first = 0

    def feed(self, role: str, text: str) -> list[tuple]:
        out: list[tuple] = []
        self.seen += 1
        if self.seen == 1 and role == SYSTEM:
            self.system = (role, text, turn_tokens(text))
            short = text if self.system[2] <= self.budget // 2 else shortened(text, self.budget // 4)
            self.again = (role, short, turn_tokens(short))
            return out
        size = turn_tokens(text)
        if self.new < len(self.turns) and self._room() < self.sums[-1] - self.sums[self.new] + size:
            out.append(self._close())
        self.turns.append((role, text))
        self.sums.append(self.sums[-1] + size)
        return out

    def finish(self) -> list[tuple]:
        if self.new < len(self.turns) or (self.system and not self.done):
            return [self._close()]
        return []

    def _room(self) -> int:
        """Tokens for new turns, next to the system turn."""
        return self.budget - ((self.again if self.done else self.system)[2] if self.system else 0)

    def _close(self) -> tuple:
        spare = min(self.history, self._room() - (self.sums[-1] - self.sums[self.new]))
        back = self.new
        while back and self.sums[self.new] - self.sums[back - 1] <= spare:
            back -= 1
        parts, loss, at = [], [], 0
        if self.system:
            role, text, _ = self.again if self.done else self.system
            parts.append(self._turn(role, text))
            at = len(parts[0])
        for i in range(back, len(self.turns)):
            role, text = self.turns[i]
            whole = self._turn(role, text)
            if i >= self.new and role == TARGET:
                end = at + len(whole) - len("<|end|>\n")
                loss.append((end - len(escape(text)), end))
            parts.append(whole)
            at += len(whole)
        fresh = len(self.turns) - self.new + (1 if self.system and not self.done else 0)
        window = (self.done, self.first, fresh, "".join(parts), loss)
        self.done += 1
        self.first += fresh
        # forget what can no longer be repeated
        keep = len(self.turns)
        while keep and self.sums[-1] - self.sums[keep - 1] <= self.history:
            keep -= 1
        self.turns, base = self.turns[keep:], self.sums[keep]
        self.sums = [s - base for s in self.sums[keep:]]
        self.new = len(self.turns)
        return window

    @staticmethod
    def _turn(role: str, text: str) -> str:
        return f"<|{escape_role(role)}|>\n{escape(text)}<|end|>\n"


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """Turns of a window: role, text (both unescaped), where the text lies."""
    return [(unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(text)]


def format_windows(rows: DataFrame, *, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows of `rows` (conv_id, turn, role, text): conv_id, window (from 0),
    first_turn (number of its first new turn in the order of turns), new_turns,
    text, loss (spans under the mask, in characters of the window's text).

    Turns are ordered by turn, then role, then text; null turns come first and
    null roles and texts are empty.  Null conv_id is a conversation of its own.
    Conversations stream through a task sorted, so no more than a window of one
    is held, however long it is.  A turn over the budget is a window alone.
    Empty table, no windows; further columns are ignored.
    """
    prepare(rows.sparkSession)
    plain = rows.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kind = plain.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out, id_type = None, None, [], pa.int64()

        def emit():
            cols = list(zip(*out))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], id_type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.string()),
                 pa.array([[{"start": a, "end": b} for a, b in x] for x in cols[5]], span)],
                ["conv_id", "window", "first_turn", "new_turns", "text", "loss"])

        for batch in batches:
            id_type = batch.column("conv_id").type
            for conv, role, text in zip(batch.column("conv_id").to_pylist(),
                                        batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                if state is None or conv != now:
                    if state is not None:
                        out += [(now, *w) for w in state.finish()]
                    now, state = conv, Windows(budget, history)
                out += [(conv, *w) for w in state.feed(role, text)]
                if len(out) >= 500:
                    yield emit()
                    out = []
        if state is not None:
            out += [(now, *w) for w in state.finish()]
        if out:
            yield emit()

    return (plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, WINDOW_SCHEMA.format(kind=kind)))


def read_back(windows: DataFrame) -> DataFrame:
    """What the formatted windows hold: conv_id, n_turns, turns_sha256 (role,
    newline, text, newline per turn), loss_chars, loss_sha256 (all text under
    the mask, unescaped), formatted_chars.

    Windows of a conversation are read in order; repeated turns are told from
    new ones by their number.  Digests run on as windows pass, none is held.
    """
    kind = windows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out, id_type = None, None, [], pa.int64()

        def close():
            out.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def emit():
            cols = list(zip(*out))
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            id_type = batch.column("conv_id").type
            for conv, number, fresh, text, loss in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "window", "new_turns", "text", "loss"))):
                if state is None or number == 0:
                    if state is not None:
                        close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = parse(text)
                # a window's system turn is new in the first window only and stands before all others
                new = turns[len(turns) - fresh:]
                state[0] += len(new)
                for role, body, _, _ in new:
                    state[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for span in loss:
                    body = unescape(text[span["start"]:span["end"]])
                    state[2] += len(body)
                    state[3].update(body.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
                if len(out) >= 500:
                    yield emit()
                    out = []
        if state is not None:
            close()
        if out:
            yield emit()

    return (windows.select("conv_id", "window", "new_turns", "text", "loss")
            .repartition("conv_id").sortWithinPartitions("conv_id", "window")
            .mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                             "loss_sha256 string, formatted_chars long"))


def formatted(rows: DataFrame, **options) -> DataFrame:
    """Format, write, read back."""
    spark = prepare(rows.sparkSession)
    path = shared_dir(spark, "windows")
    format_windows(rows, **options).write.parquet(path)
    return read_back(spark.read.parquet(path))
