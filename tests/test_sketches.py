"""The near-duplicate index over two batches against all pairs of both."""

import pathlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from harborline.operators import sketches


def words(rng, n, size=3000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def corpus():
    rng = random.Random(8)
    base, other = words(rng, 120), words(rng, 1600)
    rows = []
    for i in range(90):
        w = list(base if i < 50 else other if i < 58 else words(rng, rng.randrange(0, 60), 40))
        if i < 58:
            for _ in range(rng.randrange(0, 5 if i < 50 else 40)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    rows += [(90, None), (91, ""), (92, " \n"), (93, rows[3][1].upper()), (94, rows[60][1]), (95, "one two"), (96, "One  TWO"), (97, "two one")]
    rng.shuffle(rows)
    return rows


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_two_batches(spark, tmp_path):
    rows = corpus()
    batches = {1: sorted(rows[:40]), 2: sorted(rows[40:])}
    earlier, want = [], {}
    for b in batches.values():
        for i, text in b:
            s = shingles(text)
            # sketches of up to 1024 hashes: exact for all but the long texts, whose pairs lie far from the limit
            want[i] = {j for j, t in earlier if s and t and len(s & t) / len(s | t) >= sketches.SIMILAR}
            earlier.append((i, s))
    index = sketches.SketchIndex(spark, str(tmp_path / "index"))
    schema = "seq long, id string, text string"
    frames = {n: spark.createDataFrame([(i, f"d{i}", t) for i, t in b], schema) for n, b in batches.items()}

    def check(n):
        got = {r.seq: r for r in index.add(frames[n], n).collect()}
        assert {i: r.near_duplicate for i, r in got.items()} == {i: bool(want[i]) for i, _ in batches[n]}
        for i, r in got.items():
            assert (r.like is None) == (not want[i]) and (r.like is None or int(r.like[1:]) in want[i])

    check(1)
    check(2)
    size = spark.read.parquet(str(tmp_path / "index/bands")).count()
    check(2)  # a replay sees earlier batches only and leaves the same index
    assert spark.read.parquet(str(tmp_path / "index/bands")).count() == size
    assert sum(map(bool, want.values())) > 40
    assert index.add(frames[1].limit(0), 3).count() == 0


def test_estimate_is_exact_for_small_sets_and_close_for_large():
    rng = random.Random(1)
    for n in (3, 200, 1500, 9000):
        a = words(rng, n, 10 ** 6)
        b = list(a)
        for i in range(0, n, 40):
            b[i] = "changed"
        x, y = (sketches.shingle_set(" ".join(t)) for t in (a, b))
        s, t = shingles(" ".join(a)), shingles(" ".join(b))
        true = len(s & t) / len(s | t)
        got = sketches.similarity(x[:sketches.SKETCH], y[:sketches.SKETCH])
        assert got == true if len(s | t) <= sketches.SKETCH else abs(got - true) < 0.05


def test_sketches_are_kept_in_the_index_alone_and_buckets_searched_in_cells(spark, tmp_path, monkeypatch):
    """Each text of a family changes the one before it, so most resemble that one and not the first of the family,
    which is a bucket here."""
    rng = random.Random(3)
    rows = []
    for _ in range(6):
        w = words(rng, 500)
        for _ in range(25):
            for _ in range(7):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w)))
    batches = {1: rows[0::3], 2: rows[1::3] + rows[2::3]}
    place = {i: (n, i) for n, b in batches.items() for i, _ in b}
    sets = {i: shingles(text) for i, text in rows}
    want = {i: {j for j, t in sets.items() if place[j] < place[i] and len(s & t) / len(s | t) >= sketches.SIMILAR} for i, s in sets.items()}

    scratch = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before, found, rest, sign = set(scratch.iterdir()), [], sketches.SketchIndex._rest, sketches._sign

    def by_family(given):
        for batch in sign(given):
            keys = [[(i // 25 << 5) + band for band in range(sketches.BANDS)] for i in batch.column("seq").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("bands"), "bands", pa.array(keys, pa.list_(pa.int64())))

    monkeypatch.setattr(sketches, "_sign", by_family)
    monkeypatch.setattr(sketches, "TOGETHER", 3)
    monkeypatch.setattr(sketches.SketchIndex, "_rest", lambda self, *a: found.append(rest(self, *a)) or found[-1])
    index = sketches.SketchIndex(spark, str(tmp_path / "index"))
    for n, b in batches.items():
        got = {r.seq: r for r in index.add(spark.createDataFrame([(i, f"d{i}", t) for i, t in b], "seq long, id string, text string"), n).collect()}
        assert {i: r.near_duplicate for i, r in got.items()} == {i: bool(want[i]) for i, _ in b}
        assert all(r.like is None or int(r.like[1:]) in want[i] for i, r in got.items())
        monkeypatch.setattr(sketches, "SENT", 0)  # the second batch by shuffles
    assert sum(f.count() for f in found) > 50
    # thin rows only: the sketches are in the index, and nowhere else any more
    left = [p for table in set(scratch.iterdir()) - before for p in table.rglob("*.parquet")]
    assert left and not [p for p in left if {"sketch", "bands", "_a", "_b"} & set(pq.read_schema(p).names)]


def test_cell_against_plain_loops():
    rng = np.random.default_rng(4)
    pool = np.unique(rng.integers(0, 1 << 63, 3000, np.uint64) * np.uint64(2))
    rows = []
    for i in range(80):
        n = [60, 1300, 1010][i % 3]  # of the second and third some unions are larger than a sketch
        base = pool[:n] if i % 2 else pool[500:500 + n]
        drop = rng.random(n) < rng.choice([0, 0.03, 0.1, 0.3])
        rows.append((i, int(rng.integers(1, 3)), int(rng.integers(0, 40)), f"d{i}" if i % 7 else None, np.sort(np.r_[base[~drop], pool[rng.random(len(pool)) < 0.01]]),
                     bool(rng.random() < 0.6), bool(rng.random() < 0.7)))
    rows = [(*r[:4], np.unique(r[4])[:sketches.SKETCH], *r[5:]) for r in rows]
    cell = pa.table({**dict(zip(("set", "batch", "seq", "id"), map(list, list(zip(*rows))[:4]))),
                     "sketch": pa.array([r[4].view(np.int64) for r in rows], pa.list_(pa.int64())),
                     "asks": [r[5] for r in rows], "told": [r[6] for r in rows]})
    want = {}
    for x in rows:
        alike = [y for y in rows if x[5] and y[6] and y[1:3] < x[1:3] and sketches.similarity(x[4], y[4]) >= 0.8]
        if alike:
            first = min(alike, key=lambda y: (y[1], y[2], y[3] is not None, y[3]))
            want[x[0]] = (first[1], first[2], first[3])
    for given in (cell, pa.concat_tables([cell.slice(0, 30), cell.slice(30)])):
        got = sketches._across(0.8)(given).to_pylist()
        assert {r["set"]: (r["batch"], r["seq"], r["like"]) for r in got} == want and len(got) == len(want) > 10
