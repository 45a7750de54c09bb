"""Conversation repair against a search of all cheapest edits."""

import functools
import hashlib
import random
import zlib

import pytest

from harborline.llm import queries, repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


LEGAL = {"": {"s", "u"}, "s": {"u"}, "u": {"a"}, "a": {"u"}}


def cheapest(rows, fault):
    """(cost, audit, repaired turns) by trying all edits; states are the initials
    that came last."""
    @functools.lru_cache(None)
    def best(i, last, inserted):
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if role[0] in LEGAL[last]:
                    tail = best(i, role[0], inserted + 1)
                    if tail:
                        options.append((tail[0] + 3, "I" + tail[1], ((role, ""), *tail[2])))
        if i < len(rows):
            _, role, text = rows[i]
            tail = best(i + 1, last, 0)
            if tail:
                options.append((tail[0] + 4, "D" + tail[1], tail[2]))
            if fault[i] not in ("blank", "duplicate"):
                more = 3 if fault[i] == "truncated" else 0
                for edit, price, new in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                    if new[:1] and new[:1] in LEGAL[last]:
                        tail = best(i + 1, new[:1], 0)
                        if tail:
                            options.append((tail[0] + price + more, edit + tail[1], ((new, text), *tail[2])))
        return min(options, key=lambda o: o[:2], default=None)

    return best(0, "", 0)


def expected(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    f = faults(rows)
    turns = {t for t, *_ in rows if t is not None}
    cost, audit, out = cheapest(tuple(rows), tuple(f))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("blank"), f.count("duplicate"),
            f.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def conversations(seed, n=150):
    """Distinct turns per conversation, so that the order of rows is given."""
    r = random.Random(seed)
    out = {}
    for conv in range(n):
        turns = sorted(r.sample(range(40), r.randint(0, 12)))
        if r.random() < 0.2:
            turns = [None, *turns]
        roles = r.choice((["system", "user", "assistant"], ["user", "assistant"], ["tool", "", "user", "assistant", " "]))
        texts = r.choice((["Yes.", "No!", "Why?", "cut", "", " \n", "ok. \t"], [f"{i}." for i in range(30)]))
        out[conv] = [(t, r.choice(roles), r.choice(texts)) for t in turns]
    return out


@pytest.mark.parametrize("held, batch", [(repair.HELD, 10_000), (3, 2)])
def test_cheapest_edits(spark, held, batch):
    """The second time with batches of two rows and everything in scratch files."""
    convs = conversations(1)
    rows = [(c, *x) for c, v in convs.items() for x in v]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.createDataFrame(rows, SCHEMA)
    try:
        edits = repair.repair(docs, held=held)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        got = {r.conv_id: tuple(r) for r in repair.report(edits, in_order=True).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {c: expected(c, v) for c, v in convs.items() if v}
    again = {r.conv_id: tuple(r) for r in repair.report(edits).collect()}
    assert again == got


def test_edits_make_the_conversation(spark):
    rows = [(1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 3, "user", ""), (1, 4, "tool", "Out."), (2, 1, "system", "Be.")]
    got = {(r.conv_id, r.n): (r.turn, r.edit, r.fault, r.old_role, r.role, r.text)
           for r in repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1, -1] == (None,) * 6
    assert [got[1, i][1] for i in range(5)] == list("IKKDR")
    assert got[1, 0] == (None, "I", None, None, "user", "") and got[1, 3][2] == "blank"
    assert got[1, 4] == (4, "R", None, "tool", "assistant", "Out.")
    assert got[2, 0][1] == "D" and (2, 1) not in got


def test_repeated_rows_and_far_copies(spark):
    """A text that owns most rows of a conversation; ties in turn; equal rows."""
    rows = [(5, 0, "user", "Same."), (5, 0, "user", "Same.")] + [(5, i, "user", "Same.") for i in range(1, 3000)]
    rows += [(5, 3000, "assistant", "End."), (None, None, "user", "A."), (None, 1, "assistant", "B."), (7, 0, None, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", n string, conv int")
    got = {r.conv_id: r for r in repair.report(repair.repair(docs, held=100)).collect()}
    assert got[5].duplicate == 3000 and got[5].audit == "K" + "D" * 3000 + "K" and got[5].cost == 12_000
    assert got[None].audit == "KK" and got[None].gaps == 0 and got[7].blank == 1 and got[7].audit == "D"
    assert repair.repair(docs.limit(0)).count() == 0


def broken(conv, rows):
    """The contract's damage, row by row."""
    out = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
        role = "user" if code == 4 else role
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def test_query_damages_and_repairs(spark, tmp_path):
    convs = conversations(2, 300)
    convs[None] = [(None, "user", "A b."), (4, None, None), (9, "assistant", "")]
    convs[10 ** 17 + 1] = [(10 ** 17 + 3, "user", "Far?"), (10 ** 17 + 5, "assistant", "Yes.")]
    rows = [(c, *x, "clash") for c, v in convs.items() for x in v]
    spark.createDataFrame(rows, SCHEMA + ", code string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r) for r in queries.QUERIES["op12_structure_repair"](spark, str(tmp_path)).collect()}
    assert got == {c: expected(c, broken(c, v)) for c, v in convs.items() if v}


def test_query_on_the_given_conversations(spark):
    root = "/root/testdata/sf0.01"
    convs = {}
    for r in spark.read.parquet(f"{root}/conversations.parquet").collect():
        convs.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    got = {r.conv_id: tuple(r) for r in queries.QUERIES["op12_structure_repair"](spark, root).collect()}
    order = lambda v: sorted(v, key=lambda x: x[0])
    assert got == {c: expected(c, broken(c, order(v))) for c, v in convs.items()}
