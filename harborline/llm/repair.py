"""Conversation structure repair by a secondary-sorted stream.

Rows are repartitioned by conversation and sorted by turn; `mapInPandas` reads
them batch by batch.  Every conversation passes twice in one sorted stream: first
its thin rows (initial of the role, faults), over which a dynamic program runs,
then the same rows with their texts, to which the cheapest edits are applied.

The result must read s?(ua)+ in initials, or be empty: four states (nothing yet,
after s, after u, after a).  Keep costs 0, Rerole to user or assistant 3, Delete 4
(blank and duplicate rows must go), Insert an empty user or assistant turn 3, and
a truncated row that isn't deleted 3 more.  Of equally cheap edits those whose
initials are least as text win.  All that is carried from row to row, so also
across Arrow batches, is a cost per state and the order of the states' best edits:
edits up to a row end with that row's own, hence none is a prefix of another and
their order stays as they grow.  Costs count from the least one and a state far
above it can't win any more, so there are few such tuples and each (tuple, fault)
is worked out once.

A row leaves four bytes: per state whence and by which edit it was reached, and
its fault.  They are read backward at the end of the first pass and give a byte
per row for the second.  Beyond `HELD` bytes both go to an unnamed scratch file
of the task attempt, which nothing else reads; a lost task starts its
conversations again.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame, functions as F

from harborline.llm.runtime import prepare

#: Bytes of backpointers kept in memory, rows and text of a batch that is sent on.
HELD = 4 << 20
ROWS, CHARS = 2000, 8 << 20

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
FAULTS = (None, "blank", "duplicate", "truncated")
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3

_SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 20
#: From each state: the state an inserted or reroled turn leads to, and its role.
_NEXT, _ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
#: From each state, where initials s, u, a (0, 1, 2) lead.
_STEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
_END = (0, 2, 1, 0)  # turns inserted behind the last row
_EDITS = "DKR"


def _after(state: int, times: int) -> int:
    for _ in range(times):
        state = _NEXT[state]
    return state


class Program:
    """The dynamic program as a table of (costs, order) tuples that grows as
    they occur."""

    def __init__(self):
        self.tuples = {((0, _FAR, _FAR, _FAR), (0, 9, 9, 9)): 0}
        self.listed = list(self.tuples)
        self.known: dict[tuple[int, int], tuple[int, int, int]] = {}

    def step(self, at: int, initial: int, fault: int) -> tuple[int, int, int]:
        """Next tuple, what is added to all its costs, backpointers."""
        key = (at, initial * 4 + fault)
        if key not in self.known:
            self.known[key] = self._work_out(*self.listed[at], initial, fault)
        return self.known[key]

    def _work_out(self, costs, order, initial, fault):
        best: list = [None] * 4
        more = CUT if fault == TRUNCATED else 0
        for q in range(4):
            if costs[q] >= _FAR:
                continue
            for times in range(3):
                s, base = _after(q, times), costs[q] + INSERT * times
                ways = [(DELETE, "D", s)]
                if fault not in (BLANK, DUPLICATE):
                    ways.append((REROLE + more, "R", _NEXT[s]))
                    if initial in _STEP[s]:
                        ways.append((KEEP + more, "K", _STEP[s][initial]))
                for price, edit, to in ways:
                    way = (base + price, order[q], "I" * times + edit, q, times)
                    if best[to] is None or way < best[to]:
                        best[to] = way
        low = min(b[0] for b in best if b)
        # two states differ by at most 7 in what is still to pay
        best = [b if b and b[0] - low <= 12 else None for b in best]
        rank = {b[1:3]: i for i, b in enumerate(sorted((b for b in best if b), key=lambda b: b[1:3]))}
        new = (tuple(b[0] - low if b else _FAR for b in best), tuple(rank[b[1:3]] if b else 9 for b in best))
        pointer = fault << 28
        for to, b in enumerate(best):
            if b:  # 2 bits each: edit, state before, inserts before
                pointer |= (_EDITS.index(b[2][-1]) << 4 | b[3] << 2 | b[4]) << (6 * to)
        number = self.tuples.setdefault(new, len(self.listed))
        if number == len(self.listed):
            self.listed.append(new)
        return number, low, pointer

    def finish(self, at: int) -> int:
        """The state in which the cheapest edits leave the last row."""
        costs, order = self.listed[at]
        return min((costs[q] + INSERT * _END[q], order[q], q) for q in range(4) if costs[q] < _FAR)[2]


class Tape:
    """Numbers that are appended and then read from the end; beyond `HELD`
    bytes in a scratch file."""

    def __init__(self, kind: str, held: int):
        self.kind, self.limit, self.held, self.file, self.stored = np.dtype(kind), held, bytearray(), None, 0

    def put(self, data: bytes) -> None:
        self.held += data
        if len(self.held) > self.limit:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.write(self.held)
            self.stored += len(self.held)
            self.held.clear()

    def backward(self) -> Iterator[np.ndarray]:
        yield np.frombuffer(bytes(self.held), self.kind)[::-1]
        left, block = self.stored, max(1, self.limit // self.kind.itemsize) * self.kind.itemsize
        while left:
            size = min(block, left)
            left -= size
            self.file.seek(left)
            yield np.frombuffer(self.file.read(size), self.kind)[::-1]
        self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def _plan(pointers: Tape, state: int, held: int) -> Iterator[tuple[int, int, int]]:
    """(inserts before, edit, fault) of each row in order."""
    plan = Tape("u1", held)
    for block in pointers.backward():
        out = bytearray(len(block))
        for i, p in enumerate(block.tolist()):
            here = p >> (6 * state)
            out[i] = (p >> 28) << 4 | (here & 3) << 2 | (here >> 4 & 3)
            state = here >> 2 & 3
        plan.put(out)
    return ((b >> 2 & 3, b & 3, b >> 4) for block in plan.backward() for b in block.tolist())


_OUT = ["conv", "n", "turn", "edit", "fault", "old_role", "role", "text"]


class _Writer:
    """Output rows, as frames of bounded size."""

    def __init__(self):
        self.rows, self.chars = [], 0

    def add(self, *row) -> None:
        self.rows.append(row)
        self.chars += len(row[-1] or "")

    def full(self) -> bool:
        return len(self.rows) >= ROWS or self.chars >= CHARS

    def frame(self) -> pd.DataFrame:
        out = pd.DataFrame(self.rows, columns=_OUT, dtype=object)
        self.rows, self.chars = [], 0
        return out


def _stream(frames: Iterator[pd.DataFrame], held: int) -> Iterator[pd.DataFrame]:
    program, out = Program(), _Writer()
    now = plan = pointers = last = None
    started, n, state, tuple_, end = False, 0, 0, 0, 0

    def trailing():
        nonlocal n, state
        for _ in range(end):
            out.add(now, n, None, "I", None, None, _ROLE[state], "")
            n, state = n + 1, _NEXT[state]

    for frame in frames:
        for conv, second, gone, turn, tie, again, initial, fault, role, text in zip(
                *(frame[c].tolist() for c in ("conv", "second", "gone", "turn", "tie", "again", "initial", "fault",
                                              "role", "text"))):
            if not started or conv != now:
                if started and plan is not None:
                    trailing()
                started, now, plan, pointers, last, tuple_, end = True, conv, None, Tape("<u4", held), None, 0, 0
                out.add(conv, -1, None, None, None, None, None, None)
            if gone:
                continue
            if not second:
                # rows equal in turn, role and text stand side by side: the first of them is none too many
                if fault != BLANK and (again or last == (turn, tie)):
                    fault = DUPLICATE
                last = (turn, tie)
                tuple_, _, pointer = program.step(tuple_, initial, fault)
                pointers.put(pointer.to_bytes(4, "little"))
                continue
            if plan is None:
                final = program.finish(tuple_)
                plan, end, n, state = _plan(pointers, final, held), _END[final], 0, 0
            inserts, edit, fault = next(plan)
            for _ in range(inserts):
                out.add(now, n, None, "I", None, None, _ROLE[state], "")
                n, state = n + 1, _NEXT[state]
            new = role
            if edit == 2:
                new, state = _ROLE[state], _NEXT[state]
            elif edit == 1:
                state = _STEP[state][initial]
            out.add(now, n, turn, _EDITS[edit], FAULTS[fault], role, new, text)
            n += 1
            if out.full():
                yield out.frame()
    if started and plan is not None:
        trailing()
    if out.rows:
        yield out.frame()


def repair(rows: DataFrame, *, gone: str | None = None, held: int = HELD) -> DataFrame:
    """The cheapest edits of every conversation of `rows` (conv_id, turn, role,
    text), in order: conv_id, n (from 0), turn, edit (K, R, D or I), fault (blank,
    duplicate, truncated or none), old_role, role, text.  A row with n = -1 and
    no edit opens each conversation, also one without turns.  The repaired
    conversation is what isn't deleted.

    Faults, the first that holds: blank (nothing but ASCII white space),
    duplicate (role and text stand in an earlier row), truncated (the last other
    character isn't one of .!?).  Null roles and texts count as one space; a role
    that starts with none of s, u, a can't be kept.  Rows are taken by turn, nulls
    first, ties by a digest of role and text.  Rows equal in everything follow one
    another; all but the first are duplicates.  Null conv_id is a conversation of
    its own.  `gone` names a boolean column: such rows only announce their
    conversation.  Further columns are ignored; no rows give no rows.

    A conversation is one task's, as its edits are sequential, but no more of it
    is held than a batch and `held` bytes of backpointers.  Duplicates are found
    by a map-side combined minimum, so a text that fills most of the table
    costs one row per task; the way back joins thin rows without texts.
    """
    prepare(rows.sparkSession)
    out = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                        out.alias("gone"))
    kind = plain.schema["conv_id"].dataType.simpleString()
    body = F.rtrim("text", F.lit(_SPACE))
    digest = F.md5(F.concat(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")), F.lit("\x00"),
        F.length("role").cast("string"), F.lit("\x00"), F.col("role"), F.col("text")))
    plain = plain.withColumn("tie", digest)
    first = F.substring("role", 1, 1)
    thin = plain.select(
        "conv_id", "turn", "gone", "tie",
        F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).alias("initial"),
        F.when(body == "", BLANK).when(F.substring(body, -1, 1).isin(".", "!", "?"), 0).otherwise(TRUNCATED)
        .alias("fault"))
    # the first turn of each role and text, nulls before all others
    firsts = plain.where("not gone").groupBy("tie").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("f")) \
        .select(F.col("tie").alias("t"), F.col("f.turn").alias("first"))
    thin = thin.join(firsts, F.col("tie") == F.col("t"), "left").select(
        "conv_id", "turn", F.lit(False).alias("second"), "gone", "tie",
        (~F.col("turn").eqNullSafe(F.col("first"))).alias("again"), "initial", "fault",
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    full = plain.where("not gone").select(
        "conv_id", "turn", F.lit(True).alias("second"), "gone", "tie", F.lit(False).alias("again"),
        F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).alias("initial"),
        F.lit(0).alias("fault"), "role", "text")
    # numbers that can be null go as text: pandas would turn them into floats
    both = thin.unionByName(full).repartition("conv_id").sortWithinPartitions("conv_id", "second", "turn", "tie") \
        .withColumn("conv", F.col("conv_id").cast("string")).withColumn("turn", F.col("turn").cast("string")) \
        .drop("conv_id")
    told = both.mapInPandas(
        lambda frames: _stream(frames, held),
        "conv string, n long, turn string, edit string, fault string, old_role string, role string, text string")
    return told.select(F.col("conv").cast(kind).alias("conv_id"), "n", F.col("turn").cast("long").alias("turn"),
                       "edit", "fault", "old_role", "role", "text")


def _reports(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    price = {"D": DELETE, "K": KEEP, "R": REROLE, "I": INSERT}
    done: list[tuple] = []
    now, state = None, None

    def close():
        low, high, turns, _, faults, illegal, _, cost, audit, sha, _ = state
        done.append((now, high - low + 1 - turns if turns else 0, faults["blank"], faults["duplicate"],
                     faults["truncated"], illegal, cost, "".join(audit), sha.hexdigest()))

    for frame in frames:
        for conv, n, turn, edit, fault, old, role, text in zip(
                *(frame[c].tolist() for c in ("conv", "n", "turn", "edit", "fault", "old_role", "role", "text"))):
            if n < 0:
                if state is not None:
                    close()
                now = conv
                state = [0, 0, 0, None, dict.fromkeys(FAULTS[1:], 0), 0, None, 0, [], hashlib.sha256(), False]
                continue
            if edit != "I":
                if turn is not None and turn != state[3]:
                    state[3], value = turn, int(turn)
                    state[0] = value if not state[2] else state[0]
                    state[1], state[2] = value, state[2] + 1
                if fault is not None:
                    state[4][fault] += 1
                if state[6] is not None and state[6] + old[:1] not in ("su", "ua", "au"):
                    state[5] += 1
                state[6] = old[:1]
            state[7] += price[edit] + (CUT if fault == "truncated" and edit != "D" else 0)
            state[8].append(edit)
            if edit != "D":
                state[9].update((("\n" if state[10] else "") + f"{role}:{text}").encode())
                state[10] = True
        if len(done) >= ROWS:
            yield pd.DataFrame(done, columns=names)
            done = []
    if state is not None:
        close()
    if done:
        yield pd.DataFrame(done, columns=names)


def report(edits: DataFrame, *, in_order: bool = False) -> DataFrame:
    """Per conversation of `repair`'s rows: gaps in its turns, numbers of blank,
    duplicate and truncated rows, illegal neighbours (initials other than su, ua,
    au), the cost and the initials of the edits, and a digest of the repaired
    conversation (role:text, joined by newlines).  `in_order`: the rows come
    straight from `repair`, so they needn't be sorted again."""
    prepare(edits.sparkSession)
    kind = edits.schema["conv_id"].dataType.simpleString()
    rows = edits if in_order else edits.repartition("conv_id").sortWithinPartitions("conv_id", "n")
    told = rows.select(F.col("conv_id").cast("string").alias("conv"), "n", F.col("turn").cast("string").alias("turn"),
                       "edit", "fault", "old_role", "role", "text").mapInPandas(
        _reports, "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                  "audit string, repaired_sha256 string")
    return told.select(F.col("conv").cast(kind).alias("conv_id"), *told.columns[1:])


def damaged(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, role, text) with one in four damaged, by a hash of
    conversation and turn modulo 20: 0 drops the row (it stays, with `gone`), 1
    empties its text, 2 takes out .!?, 3 repeats it, 4 makes its role user.
    Null values count as one space, but a null turn and conversation stay null."""
    code = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                               F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", "turn", "role", "text", code.alias("code")).select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"), (F.col("code") == 0).alias("gone"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")
