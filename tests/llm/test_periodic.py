"""Periodic runs against all lags at all places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from harborline.llm import periodic, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def smallest_period(w):
    return next(p for p in range(1, len(w) + 1) if all(w[i] == w[i + p] for i in range(len(w) - p)))


def brute(words):
    """All runs by start and period: every lag, every maximal stretch on it."""
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(12, 2 * q) and smallest_period(words[i:i + length]) == q:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed):
    """Random words of small and large vocabularies with planted, nested,
    neighbouring and broken repetitions."""
    r = random.Random(seed)
    out = []
    for _ in range(60):
        words = []
        while len(words) < r.choice((5, 13, 40, 150, 300)):
            kind = r.random()
            if kind < 0.4 and words:
                p = r.randint(1, min(len(words), r.choice((3, 12, 60))))
                block = words[-p:]
                words += (block * 9)[:r.randint(1, r.choice((1, 3, 8)) * p)]
            elif kind < 0.5:
                x, y = r.choice("ab"), r.choice("abc")
                words += [x, y] * r.randint(1, 20)
            else:
                words += [r.choice("abcdefgh"[:r.choice((2, 3, 8))]) for _ in range(r.randint(1, 9))]
        out.append(words)
    fib = ["a"], ["a", "b"]
    while len(fib[1]) < 300:
        fib = fib[1], fib[1] + fib[0]
    return out + [fib[1], ["x"] * 400, ["x", "y"] * 100 + ["y", "x"] * 100, [], ["one"], list("aab" * 30 + "aaab" * 30)]


@pytest.mark.parametrize("seed", range(6))
def test_all_runs_are_found(seed):
    cases = texts(seed)
    found, bounds, left = periodic.runs_of([" ".join(w).encode() for w in cases])
    for i, words in enumerate(cases):
        want = brute(words)
        assert [tuple(x) for x in found[bounds[i]:bounds[i + 1]].tolist()] == want
        assert left[i].decode() == collapsed(words, want)


def test_work_stays_linear_where_all_repeats():
    """A hundred thousand equal words, and a long period of them: few seeds."""
    n = 100_000
    for words in (["x"] * n, (["x"] * 999 + ["y"]) * 100, [f"w{i % 30_000}" for i in range(n)]):
        found, _, left = periodic.runs_of([" ".join(words).encode()])
        p = len(set(words)) if len(set(words)) != 2 else 1000
        assert [0, n, p] in found.tolist()
        assert len(left[0].split()) <= p


def planted(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = brute(words)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(i, " ".join(w), "clash", 1) for i, w in enumerate(texts(9))]
    rows += [(None, "a b " * 20, None, None), (None, None, "x", 2), (900, "", "x", 3), (901, " \t\n", "x", 3),
             (902, "é é é é " * 12, "x", 4), (3, rows[3][1], "clash", 1), (903, "A a " * 30, "x", 1),
             (904, " ".join(f"w{i}" for i in range(700)), "x", 5), (-5, "one\x0btwo\x1cthree " * 15, "x", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, body long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:2], str(r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted((expected(i, t) for i, t, *_ in rows), key=key)
    kept = periodic.periodic_runs(docs)
    assert kept.columns == ["doc_id", "text", "body", "runs", "collapsed"] and kept.count() == len(rows)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_query_on_the_given_documents(spark):
    root = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, root).collect()}
    short = [r for r in rows if len((r.text or "").split()) < 600]
    assert len(got) == len(rows) and len(short) > 100
    for r in short:
        assert got[r.doc_id] == expected(r.doc_id, r.text)
