"""What Python workers hold beside the batch they work on."""

import public_tokenizers
import pyarrow as pa

from pyspark.sql import functions as F

from harborline.llm import decontaminate, encode, langid, packing, runtime


def _tables(tool):
    return sum(x.nbytes for x in (tool.keys, tool.at, tool.first, tool.length, tool.pool))


def test_encoder_tables_grow_with_the_pieces():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tool = encode.Encoder(path, "spaced")
    list(tool.encode([b"few words only"]))
    assert _tables(tool) < 4 << 20
    texts = [" ".join(f"w{i * 7919 % 100003}x" for i in range(k, k + 20_000)) for k in range(0, 80_000, 20_000)] * 2
    whole = [e.ids for e in tool.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    got = []
    for _, _, ids, bounds in tool.encode([t.encode() for t in texts]):
        got += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == whole and tool.n <= len(tool.keys) // 2
    assert _tables(tool) < 16 << 20


def test_a_worker_keeps_the_tables_of_one_operator():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode.encoder(path, "spaced")
    assert encode.encoder(path, "spaced") is encode.encoder(path, "spaced")
    assert list(runtime._KEPT) == [(path, "spaced")]
    assert list(runtime.lean(lambda batches: batches, (path, "spaced"))(iter([1]))) == [1]
    assert list(runtime._KEPT) == [(path, "spaced")]
    assert list(runtime.lean(lambda batches: batches)(iter([1, 2]))) == [1, 2]
    assert not runtime._KEPT


def test_workers_that_packed_forget_the_tokenizer(spark):
    docs = spark.createDataFrame([(i, f"some words {i}", "en") for i in range(40)],
                                 "doc_id long, text string, lang string").repartition(4)
    items = spark.createDataFrame([("a", "some words 1 2 3")], "item_id string, text string")

    def look(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"kept": [sorted(map(str, runtime._KEPT))]}, pa.schema([("kept", pa.list_(pa.string()))]))

    def kept():
        rows = spark.range(0, 40, 1, 4).mapInArrow(look, "kept array<string>").collect()
        return {k for r in rows for k in r.kept}

    name = public_tokenizers.path("byte_bpe_50k.json")
    for _ in range(3):  # so that every worker has had a task
        assert packing.pieces(docs, name).count() == 40
    assert any(name in k for k in kept())
    for _ in range(3):
        langid.train(docs)
        decontaminate.contamination(docs, items).agg(F.max("n_hit")).collect()
    assert not any(name in k for k in kept())
