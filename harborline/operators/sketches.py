"""Near-duplicates of a batch, found in an index of sketches.

A document's set are the hashes of its shingles (five words in a row, ASCII-lowered;
a shorter text is one shingle).  The index keeps, once per distinct set, its
`SKETCH` smallest hashes and its keys in `BANDS` bands of minima.  Two sets that agree
in a band are compared by their sketches: of the `SKETCH` smallest hashes of
both together, the share that is in both estimates the similarity, and is it where there
are no more.  Old texts are never read again.

Layout: `bands/batch_id=N/band=B/*.parquet` and `sets/batch_id=N/*.parquet`.  A batch owns
its directories, sees only earlier batches and overwrites what a first attempt left, so a
replay changes nothing.

Sketches and bands are larger than the texts they are of, so they are written twice only: signed,
and as the index.  Who is compared is settled on thin rows; sketches are then picked out of the
index where it is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from harborline.operators.forest import lookup
from harborline.session import materialize, prepare, shared_dir

WORDS, SKETCH = 5, 1024
#: 25 bands of 4 rows miss a pair of similarity 0.8 with probability 2e-6.
BANDS, ROWS, SIMILAR = 25, 4, 0.8
BLOCK = 1 << 16

_U = np.uint64
_SEEDS = np.array([xxhash.xxh64_intdigest(str(i)) for i in range(BANDS * ROWS)], _U)

_BAND = "key long, set long, at struct<batch:long,seq:long>, band int"
_SET = "set long, n long, at struct<batch:long,seq:long>, id string, sketch array<long>"
_SIGNED = "seq long, id string, set long, n long, sketch array<long>, bands array<long>"
#: So many keys or masks at most are sent to all tasks; beyond it the same join shuffles.
SENT = 1_000_000
#: Band entries a task writes, at least; each makes a file per band.
ENTRIES = 1 << 21
#: Sets of a bucket that are held against as many others at a time.
TOGETHER = 2000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct shingle hashes, sorted; none if there are no words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, _U)
    h = np.array([xxhash.xxh64_intdigest(w) for w in words], _U)
    size = min(WORDS, len(h))
    out = _U(size) * np.ones(len(h) - size + 1, _U)
    for i in range(size):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + h[i:len(h) - size + 1 + i])
    return np.unique(out)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    least = np.full(len(_SEEDS), _U(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(hashes), BLOCK // 8):
        least = np.minimum(least, _mix(hashes[at:at + BLOCK // 8, None] ^ _SEEDS[None, :]).min(axis=0))
    keys = np.arange(BANDS, dtype=_U)
    for column in least.reshape(BANDS, ROWS).T:
        keys = _mix(keys * _U(0x9E3779B97F4A7C15) + column)
    return keys


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Estimate from two sketches (sorted, of one size); exact for small sets."""
    both = np.union1d(a, b)[:SKETCH]
    common = np.intersect1d(a, b, assume_unique=True)
    return np.isin(both, common, assume_unique=True).sum() / max(1, len(both))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets, sizes, sketches, bands = [], [], [], []
        for text in batch.column("text").to_pylist():
            h = shingle_set(text)
            sizes.append(len(h))
            sets.append(xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63))
            sketches.append(h[:SKETCH].view(np.int64))
            bands.append(band_keys(h).view(np.int64) if len(h) else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("seq"), batch.column("id"), pa.array(sets, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(sketches, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
            ["seq", "id", "set", "n", "sketch", "bands"])


@F.pandas_udf(T.DoubleType())
def _alike(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(np.asarray(x).view(_U), np.asarray(y).view(_U)) for x, y in zip(a, b)], dtype=float)


def _across(least: float):
    """For the askers of a cell, the earliest of its others that come before them and are alike."""
    def across(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        lists = cell.column("sketch").chunk(0)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        hashes, size, m = lists.flatten().to_numpy().view(_U), np.diff(bounds), len(lists)
        order = np.argsort(hashes, kind="stable")
        listed, in_order = np.repeat(np.arange(m), size)[order], hashes[order]
        lo, hi = np.searchsorted(in_order, hashes, "left"), np.searchsorted(in_order, hashes, "right")
        batch, seq, told = (cell.column(c).to_numpy() for c in ("batch", "seq", "told"))
        asks = cell.column("asks").to_numpy()
        ids, found = cell.column("id").to_pylist(), []
        for x in np.flatnonzero(asks).tolist():
            a, z = lo[bounds[x]:bounds[x + 1]], hi[bounds[x]:bounds[x + 1]]
            common = np.bincount(np.concatenate([listed[i:j] for i, j in zip(a, z)]), minlength=m)
            union = size[x] + size - common
            # of a larger union no more than `common` of the `SKETCH` smallest are in both
            near = told & (common / np.minimum(union, SKETCH) >= least) & ((batch < batch[x]) | ((batch == batch[x]) & (seq < seq[x])))
            for y in sorted(np.flatnonzero(near).tolist(), key=lambda y: (batch[y], seq[y], ids[y] is not None, ids[y])):
                if union[y] <= SKETCH or similarity(hashes[bounds[x]:bounds[x + 1]], hashes[bounds[y]:bounds[y + 1]]) >= least:
                    found.append((x, y))
                    break
        x, y = (pa.array(side, pa.int64()) for side in (zip(*found) if found else ((), ())))
        return pa.table([cell.column("set").take(x), *(cell.column(c).take(y) for c in ("batch", "seq", "id"))],
                        ["set", "batch", "seq", "like"])
    return across


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= SENT else table


def picked(wide: DataFrame, ids: DataFrame, place: str, *same: str) -> DataFrame:
    """The rows of `wide` whose `place`, a long, and `same` columns are in `ids`.

    Wide rows stay where they are: what goes to all tasks are bit masks of 64 places each.
    """
    spot = lambda df: df.withColumn("_block", F.shiftright(place, 6)).withColumn("_bit", F.expr(f"shiftleft(1L, cast({place} & 63 as int))"))
    masks = materialize(spot(ids).groupBy(*same, "_block").agg(F.bit_or("_bit").alias("_mask")), "masks")
    if masks.count() > SENT:
        return wide.join(ids, [*same, place], "left_semi")
    return spot(wide).join(F.broadcast(masks), [*same, "_block"]).where("_mask & _bit <> 0").select(*wide.columns)


class SketchIndex:
    """An index on a shared path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = prepare(spark), path.rstrip("/")

    def _place(self, folder: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _stored(self, name: str, schema: str, which: Column) -> DataFrame:
        system, folder = self._place(f"{self.path}/{name}")
        if not system.exists(folder):
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(full).parquet(f"{self.path}/{name}").where(which).drop("batch_id")

    def _indexed(self, docs: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Writes the batch's new sets and their bands.  Its rows (seq, id, set, n), each set's first
        (set, seq, id) and those of the sets that earlier batches had (set, like, at)."""
        rows = docs.select("seq", F.col("id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
        path = shared_dir(self.spark, "signed")
        rows.mapInArrow(_sign, _SIGNED).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
        signed = self.spark.read.schema(f"{_SIGNED}, row long").parquet(path)
        thin = materialize(signed.select("seq", "id", "set", "n", "row"), "rows")
        heads = materialize(thin.where("n > 0").groupBy("set").agg(F.min_by(F.struct("seq", "id", "row"), "seq").alias("h"))
                            .select("set", "h.*"), "heads")
        stored = self._stored("sets", _SET, F.col("batch_id") < batch_id)
        known = materialize(stored.select("set", "id", "at").join(heads.select("set"), "set", "left_semi")
                            .groupBy("set").agg(F.min(F.struct("at", "id")).alias("x")).select("set", F.col("x.id").alias("like"), "x.at"), "known")
        new = materialize(heads.join(known.select("set"), "set", "left_anti").select("row"), "new")
        fresh = picked(signed, new, "row").withColumn("at", F.struct(F.lit(batch_id).cast("long").alias("batch"), "seq"))
        fresh.select(*[f.name for f in T.StructType.fromDDL(_SET)]).write.mode("overwrite").parquet(f"{self.path}/sets/batch_id={batch_id}")
        tasks = max(self.spark.sparkContext.defaultParallelism, new.count() * BANDS // ENTRIES)
        fresh.select("set", "at", F.posexplode("bands").alias("band", "key")).select("key", "set", "at", "band").coalesce(tasks) \
            .write.mode("overwrite").partitionBy("band").parquet(f"{self.path}/bands/batch_id={batch_id}")
        system, folder = self._place(path)
        system.delete(folder, True)  # the index has it now
        return thin, heads, known

    def _rest(self, rest: DataFrame, sets: DataFrame, least: float) -> DataFrame:
        """(set, like) of the sets that ask and resemble an earlier one of a bucket.

        A bucket isn't expanded to pairs: it is a square of cells, askers by others, of bounded size.
        """
        blocks = lambda n: F.ceil(F.col(n) / TOGETHER).cast("int")
        sizes = materialize(rest.groupBy("key").agg(F.count("*").alias("m"), F.count_if("asks").alias("l")).where("m > 1 and l > 0")
                            .select("key", blocks("m").alias("m"), blocks("l").alias("l")), "sizes")
        dealt = materialize(lookup(rest, sizes, "key", "inner")
                            .withColumn("i", F.pmod(F.xxhash64("set"), "l").cast("int")).withColumn("j", F.pmod(F.xxhash64("set"), "m").cast("int")), "dealt")
        # each as one of the others in every row of its column, an asker in every column of its row, too
        cells = F.expr("""concat(transform(sequence(0, l - 1), x -> struct(x as i, j as j, asks and x = i as asks, true as told)),
            transform(filter(sequence(0, m - 1), x -> asks and x <> j), x -> struct(i as i, x as j, true as asks, false as told)))""")
        wide = picked(sets, dealt.select("batch", "seq"), "seq", "batch").select("set", "id", "sketch")
        found = dealt.select("key", "set", "batch", "seq", F.explode(cells).alias("cell")).join(wide, "set") \
            .select("key", "cell.*", "set", "batch", "seq", "id", "sketch") \
            .groupBy("key", "i", "j").applyInArrow(_across(least), "set long, batch long, seq long, like string")
        return materialize(found.groupBy("set").agg(F.min(F.struct("batch", "seq", "like")).alias("x")).select("set", "x.like"), "near")

    def add(self, docs: DataFrame, batch_id: int, least: float = SIMILAR) -> DataFrame:
        """Index a batch (seq, id, text) and tell, per row: seq, id, near_duplicate
        and, if so, `like`, the id of an earlier document that it resembles to at least
        `least`.  Earlier are those of earlier batches and those with a smaller `seq`.

        Equal sets are compared as one; a set's first document stands for it.  A
        set is held against the earliest of each of its buckets first.  Only one
        that resembles none of these is held against the others there.  Null and
        wordless texts resemble nothing.  `seq` is unique within a batch.
        """
        rows, heads, known = self._indexed(docs, batch_id)
        sets = self._stored("sets", _SET, F.col("batch_id") <= batch_id).select("set", "id", "sketch", "at.batch", "at.seq")
        old, own = (self._stored("bands", _BAND, which).select("key", "set", "at")
                    for which in (F.col("batch_id") < batch_id, F.col("batch_id") == batch_id))
        # A key is of one band, as bands are hashed with their number.  Only buckets of several sets go on.
        several = own.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
        met = old.select("key").join(own.select("key"), "key", "left_semi")
        shared = materialize(several.unionByName(met).distinct(), "shared")
        members = materialize(old.unionByName(own).join(_few(shared), "key", "left_semi"), "members")
        first = materialize(members.groupBy("key").agg(F.min(F.struct("at", "set")).alias("top"))
                            .select("key", F.col("top.at").alias("at"), F.col("top.set").alias("other")), "first")

        def resembling(pairs: DataFrame) -> DataFrame:
            """(set, like, at): the earliest of the partners that are alike."""
            pairs = materialize(pairs.distinct(), "pairs")
            sketches = lambda at: picked(sets, pairs.select(f"{at}.batch", f"{at}.seq"), "seq", "batch")
            theirs = sketches("at").select(F.col("set").alias("other"), F.col("sketch").alias("_b"), F.col("id").alias("like"))
            mine = sketches("own").select("set", F.col("sketch").alias("_a"))
            both = lookup(pairs, theirs, "other", "inner").join(mine, "set")
            return materialize(both.where(_alike("_a", "_b") >= least).groupBy("set").agg(F.min(F.struct("at", "like")).alias("x"))
                               .select("set", "x.like"), "near")

        mine = members.where(F.col("at.batch") == batch_id).select("key", "set", F.col("at").alias("own"))
        near = resembling(lookup(mine, first, "key", "inner").where("at < own").select("set", "own", "other", "at"))
        left = mine.join(near.select("set"), "set", "left_anti")
        last = left.join(first, "key").where("at < own").groupBy("key").agg(F.max("own").alias("last"))
        asked = last.join(first.select("key", F.col("other").alias("_top")), "key")
        rest = materialize(lookup(members, asked, "key", "inner").where("set <> _top and at <= last")
                           .join(near.select("set", F.lit(True).alias("_near")), "set", "left")
                           .select("key", "set", "at.batch", "at.seq", (F.col("at.batch").eqNullSafe(batch_id) & F.isnull("_near")).alias("asks")), "rest")
        near = near.unionByName(self._rest(rest, sets, least))

        # a copy resembles the first with its set; that one what was found for it
        firsts = heads.select("set", F.col("seq").alias("_seq"), F.col("id").alias("_id"))
        found = known.select("set", "like").unionByName(near)
        told = lookup(rows.where("n > 0").select("seq", "id", "set"), firsts.join(found, "set", "left"), "set").select(
            "seq", "id", F.when(F.col("_seq") < F.col("seq"), F.coalesce("like", "_id")).otherwise(F.col("like")).alias("like"),
            ((F.col("_seq") < F.col("seq")) | F.col("like").isNotNull()).alias("near_duplicate"))
        bare = rows.where("n = 0").select("seq", "id", F.lit(None).cast("string").alias("like"), F.lit(False).alias("near_duplicate"))
        return told.unionByName(bare).select("seq", "id", "near_duplicate", "like")
