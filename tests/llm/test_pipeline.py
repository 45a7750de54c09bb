"""The pipeline's stages keep the columns of documents and their decisions hold."""

import os

import numpy as np
import pytest

import corpus_pipeline

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            assert 0 < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before


def test_odd_rows(spark, tmp_path):
    rows = [(1, "the cat and the dog of it", "en", "a", 25), (1, "the cat and the dog of it", "en", "a", 25),
            (2, None, "en", None, None), (None, "the house and the tree a@b.cd", None, "b", 9), (3, "", "de", "b", 0),
            (4, "der hund und die katze nicht", "de", "b", 28), (5, "!!!", "de", "b", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, "some item of the benchmark")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for table in (docs, docs.limit(0)):
        now = table
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
        got = [r.doc_id for r in now.collect()]
        assert len(got) == len(set(got)) and set(got) <= {1, 4, None}


def similarity(a, b):
    x, y = ({tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(x & y), len(x | y)


def test_near_duplicates_from_four_fifths_on(spark):
    rng, rows = np.random.default_rng(8), []
    for i in range(40):  # ten to twelve words in a row are new: 132 / 160, 131 / 161 and 130 / 162
        base = rng.integers(0, 1_000_000, 150)
        other = base.copy()
        at, n = rng.integers(5, 130), 10 + i % 5
        other[at:at + n] = rng.integers(0, 1_000_000, n)
        rows += [(2 * i, " ".join(map(str, base))), (2 * i + 1, " ".join(map(str, other)))]
    alike = {a[0]: similarity(a[1], b[1]) for a, b in zip(rows[::2], rows[1::2])}
    between = sum(80 * n <= 100 * both < 85 * n for both, n in alike.values())
    assert 0 < between < len(alike)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, DATA).collect()}
    assert got == {i for i, _ in rows if i % 2 == 0 or 100 * alike[i - 1][0] < 80 * alike[i - 1][1]}


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcde")
    rows = [(1, a, "p"), (1, b, "p"), (2, a, "p"), (3, c, "p"), (5, c + " more", "p"), (5, d, "p"), (5, d, "q"),
            (None, a, "p"), (None, e, "p"), (None, e, "p"), (None, None, "p"), (None, None, "p"), (7, "", "p"), (8, "", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, DATA).collect()]
    assert sorted((r[:2] for r in got), key=str) == sorted(
        [(1, a), (1, b), (3, c), (5, d), (None, e), (None, None), (None, None), (7, ""), (8, "")], key=str)
    other = corpus_pipeline.drop_near_duplicates(spark, docs.orderBy(docs.source.desc()).coalesce(1), DATA)
    assert sorted(map(tuple, other.collect()), key=str) == sorted(got, key=str)
