"""Forests against plain walks: deep, wide, cyclic, with parents that are missing."""

import random

import pytest

from harborline.operators import forest


def climb(parent):
    """node -> (root, path of nodes below the root); a cycle is cut at its least node."""
    cut = set()
    for v in parent:
        seen, x = [], v
        while x in parent and x not in seen:
            seen.append(x)
            x = parent[x]
        if x in seen:
            cut.add(min(seen[seen.index(x):]))
    out = {}
    for v in parent:
        if v not in cut:
            way, x = [], v
            while x in parent and x not in cut:
                way.append(x)
                x = parent[x]
            out[v] = (x, way[::-1])
    return out


def forests(seed):
    r = random.Random(seed)
    yield {i: i - 1 for i in range(1, 200)}                        # one chain
    yield {i: 0 for i in range(1, 200)}                            # one star
    yield {i: (i + 1) % 9 for i in range(9)} | {i: i - 9 for i in range(9, 60)}  # a ring with tails
    yield {1: 1, 2: 1, 3: 4}                                       # its own parent; a missing parent
    yield {i: r.randrange(120) for i in range(100)}                # many rings, some ways out
    yield {i: r.randrange(max(1, i)) for i in range(1, 150)}
    yield {}


@pytest.mark.parametrize("few", [forest.FEW, 0])
def test_ascend(spark, monkeypatch, few):
    """All forests in one table; `few` = 0 looks for hot keys in every table."""
    monkeypatch.setattr(forest, "FEW", few)
    parent = {1000 * i + v: 1000 * i + p for i, f in enumerate(list(forests(3))[:: 2 if few == 0 else 1]) for v, p in f.items()}
    links = spark.createDataFrame([(v, p, v) for v, p in parent.items()], "node long, parent long, step long")
    want = climb(parent)
    if few:
        got = {r.node: (r.root, r.depth, r.path) for r in forest.ascend(links, path=True).collect()}
        assert got == {v: (root, len(way), way) for v, (root, way) in want.items()}
        assert forest.ascend(links.limit(0), path=True).count() == 0
    else:
        got = {r.node: (r.root, r.depth) for r in forest.ascend(links).collect()}
        assert got == {v: (root, len(way)) for v, (root, way) in want.items()}


def test_lookup_keeps_rows_of_hot_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(forest, "FEW", 0)
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else 1 if i % 2 else i) for i in range(1000)], "i long, k long")
    table = spark.createDataFrame([(k, -k) for k in range(0, 1000, 3)] + [(1, -1)], "k long, v long")
    want = rows.join(table, "k", "left").collect()
    assert sorted(map(str, forest.lookup(rows, table, "k").select("k", "i", "v").collect())) == sorted(map(str, want))
    assert forest.lookup(rows, table, "k", "inner").count() == rows.join(table, "k").count()


def test_numbered(spark):
    rows = spark.range(1000).selectExpr("id % 10 as a", "id as b")
    got = forest.numbered(rows, ["a", "b"], "n").orderBy("n").collect()
    assert [(r.a, r.b, r.n) for r in got] == [(*x, n) for n, x in enumerate(sorted((i % 10, i) for i in range(1000)))]
    assert forest.numbered(rows.limit(0), ["a", "b"], "n").count() == 0


def test_preorder(spark):
    """A random forest, a chain and a star in one table, ties among siblings."""
    r = random.Random(5)
    parent = {0: None} | {i: p if (p := r.randrange(-2, i)) >= 0 else None for i in range(1, 60)}
    parent |= {100: None} | {i: i - 1 for i in range(101, 170)} | {200: None} | {i: 200 for i in range(201, 260)}
    key = {v: r.randrange(5) for v in parent}
    want, stack = [], sorted((v for v in parent if parent[v] is None), key=lambda v: (key[v], v), reverse=True)
    while stack:
        v = stack.pop()
        want.append(v)
        stack += sorted((c for c in parent if parent[c] == v), key=lambda c: (key[c], c), reverse=True)
    tree = spark.createDataFrame([(v, p, key[v]) for v, p in parent.items()], "node long, parent long, k long")
    got = forest.preorder(tree, ["k"]).orderBy("place").collect()
    assert [x.place for x in got] == list(range(len(parent))) and [x.node for x in got] == want
    assert forest.preorder(tree.limit(0), ["k"]).count() == 0
