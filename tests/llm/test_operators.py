"""Each operator on small tables against a brute-force version, and on odd
ones: nulls, empty and long texts, ties, repeated rows, no rows, extra columns."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from harborline.llm import (chat, decontaminate, katz, langid, neardup, ordinal, packing, pii, rules,
                            wavelet)
from harborline.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
LONG = " ".join(f"w{i}" for i in range(30_000))

# doc_id, text, and columns whose names clash with those of the operators
ROWS = [
    (1, BASE, "x", 1), (2, BASE, "x", 2), (2, BASE, "x", 2), (3, BASE.upper(), None, 3),
    (4, None, None, None), (None, "no id here, mail a.b@c.de", "y", 5), (5, "", "y", 6),
    (6, LONG, "y", 7), (7, "short text", "y", 8), (8, "short text", "y", 9),
    (9, "call +1 (017) 555-7713 or 10.0.0.1, 4111 1111 1111 1111", "y", 10), (10, "1234 !!! ???", "y", 11),
]
SCHEMA = "doc_id long, text string, n_words string, key long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sets(rows):
    out = []
    for i, text, *_ in rows:
        w = WORD.findall(lower(text))
        out.append((i, {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    return out


def test_components(spark):
    edges = [(9, 4), (4, 2), (7, 8), (8, 8), (None, 3), (5, 9), (5, 9)] + [(i, i + 1) for i in range(20, 60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k < 20} == {2: 2, 4: 2, 9: 2, 5: 2, 7: 7, 8: 7}
    assert {v for k, v in got.items() if k >= 20} == {20}


def test_near_duplicates_odd_rows(odd, none):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert got[1] == (11, 1, True) and got[2] == (11, 1, False) and got[3] == (11, 1, False)
    assert got[4] == (0, 4, True) and got[5] == (0, 5, True)
    assert got[None][1:] == (None, True)
    assert got[6] == (29_996, 6, True) and got[7] == (1, 7, True) and got[8] == (1, 7, False)
    assert neardup.near_duplicates(none).collect() == []


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 10_000, 150)
    rows = []
    for i in range(160):  # edits of one text, some of which link and some do not, and others
        w = base.copy() if i < 110 else rng.integers(0, 50, rng.integers(1, 80))
        if i < 110:
            w[rng.integers(0, 150, rng.integers(0, 4))] = rng.integers(0, 10_000)
        rows.append((i, " ".join(map(str, w))))
    s = sets(rows)
    parent = list(range(len(s)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in s:
        for j, b in s[:i]:
            both = len(a & b)
            if 100 * both >= 85 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: find(i) for i, _ in s}


def test_sketch_fills_and_estimates():
    sets_ = [np.arange(1, 2, dtype=np.uint64), np.arange(1, 400, dtype=np.uint64), np.arange(60, 460, dtype=np.uint64)]
    w, bounds = np.concatenate(sets_), np.cumsum([0, *map(len, sets_)])
    s = neardup.sketch(w, bounds, 512)
    assert (s != neardup._EMPTY).all()
    true = len(np.intersect1d(sets_[1], sets_[2])) / len(np.union1d(sets_[1], sets_[2]))
    assert abs((s[1] == s[2]).mean() - true) < 0.08


def contaminated(rows, items):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall(lower(text))
        for k in range(max(1, len(w) - 12) if w else 0):
            if item is not None:
                windows[tuple(w[k:k + 13])].add(str(item))
    out = []
    for i, text, *_ in rows:
        w, hit, found = word.findall(lower(text)), set(), set()
        for p, owners in windows.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    found |= owners
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_contamination(spark, odd, none, block):
    items = [(1, BASE.replace(" ", "-")), (2, "Short, text!"), (2, "w7 w8"), (None, "w1 w2"), (3, None), (4, "..."),
             (10, "two three four five six seven eight nine ten eleven twelve thirteen fourteen")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(odd, table, block_bytes=block)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got.drop("hit_spans").collect()), key=key) == sorted(contaminated(ROWS, items), key=key)
    span = got.where("doc_id = 1").first().hit_spans
    assert [(s.start, s.end) for s in span] == [(0, len(BASE))]
    assert decontaminate.contamination(none, table).collect() == []
    assert decontaminate.contamination(odd, table.limit(0)).where("n_hit > 0").count() == 0


def test_language(spark, odd, none):
    en, de = "the and of to with that", "der und die nicht ist das"
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice((en if i % 2 else de).split(), 12)), "en" if i % 2 else "de") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs.where("doc_id < 80"))
    got = langid.predict(docs, model).collect()
    assert all(r.lang_pred == r.lang and 0.5 < r.score <= 1 for r in got)
    seen = {r.doc_id: r for r in langid.predict(odd, model, keep=[F.col("doc_id"), F.col("key")]).collect()}
    assert {i for i, r in seen.items() if r.lang_pred == "und" and r.score == 0} == {4, 5, 10}
    assert langid.predict(none, model).count() == 0
    empty = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"}


def test_letters_are_unicode_letters():
    assert langid.has_letter("²é") and not langid.has_letter("²½_1") and not langid.has_letter("")


def test_ordinal(spark, odd, none):
    rng = np.random.default_rng(2)
    filler = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = []
    for i in range(400):
        grade = i % 3
        w = list(rng.choice(filler, 20)) + [["awful"], ["meh"], ["fine"]][grade]
        rows.append((i, " ".join(w), grade))
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = ordinal.train(docs.where("doc_id < 300"))
    assert (np.diff(model.thresholds) > 0).all()
    held = ordinal.score(docs.where("doc_id >= 300"), model).collect()
    assert all(round(r.expected_grade) == r.grade and (r.tail_probability > 0.5) == (r.grade == 2) for r in held)
    assert ordinal.score(odd, model).count() == len(ROWS) and ordinal.score(none, model).count() == 0
    assert ordinal.train(docs.where("grade = 1")) is None
    assert ordinal.score(odd, None).where("expected_grade is not null").count() == 0


def test_katz_is_normalised_and_right(spark, odd, none):
    rows = [(i, " ".join(np.random.default_rng(i).choice(list("abcdefgh"), 9))) for i in range(30)] + [(99, "a zz b")]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string")
    got = {r.doc_id: r for r in katz.scored(docs, F.col("doc_id") >= 25).collect()}
    train = [t.split() + ["</s>"] for i, t in rows + rows[:2] if i < 25]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip(["<s>"] + t, t))
    before = Counter(h for h, w in two.elements())
    total = sum(one.values())

    def discount(counts):
        d = katz.discounts(Counter(counts.values()))
        return lambda c: d[c - 1] if c <= katz.K else 1.0

    d1, d2 = discount(one), discount(two)
    low = {w: d1(c) * c / (total + 1) for w, c in one.items()}
    unknown = 1 - sum(low.values())

    def p(h, w):
        if two[h, w]:
            return d2(two[h, w]) * two[h, w] / (before[h] + 1)
        seen = [x for x in one if two[h, x]]
        left = (1 - sum(d2(two[h, x]) * two[h, x] / (before[h] + 1) for x in seen)) / (1 - sum(low[x] for x in seen))
        return left * low.get(w, unknown)

    for h in ["<s>", "a", "zz"]:
        assert math.isclose(sum(p(h, w) for w in [*one, "?"]), 1)
    for i, t in rows:
        w = t.split() + ["</s>"]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(x in one for x in w), total, i >= 25)
        assert math.isclose(r.base_score, sum(math.log10((one[x] + 1) / (total + len(one) + 1)) for x in w), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(p(h, x)) for h, x in zip(["<s>"] + w, w)), rel_tol=1e-9)
    odd_got = katz.scored(odd, F.lit(False)).collect()
    assert len(odd_got) == len(ROWS) and {r.n_tokens for r in odd_got if r.doc_id in (4, 5)} == {1}
    assert katz.scored(odd, F.lit(True)).where("n_known > 0 or train_tokens > 0").count() == 0
    assert katz.scored(none, F.lit(False)).count() == 0


def test_katz_splits_hot_words_alike(spark, monkeypatch):
    rows = [(i, "the " * 5 + " ".join(np.random.default_rng(i).choice(list("abcdefgh"), 9))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(katz, "SAMPLED", 1)
    split = {r.doc_id: r for r in katz.scored(docs, F.col("doc_id") % 5 == 0, bucket_bytes=200).collect()}
    monkeypatch.setattr(katz, "HOT", 2.0)
    whole = {r.doc_id: r for r in katz.scored(docs, F.col("doc_id") % 5 == 0).collect()}
    for i, r in whole.items():
        assert r[:5] == split[i][:5] and math.isclose(r.score, split[i].score) and math.isclose(r.base_score, split[i].base_score)


def pii_base(text):
    luhn = lambda d: sum((v - 9 if v > 9 else v) for i, c in enumerate(reversed(d))
                         for v in [int(c) * (2 if i % 2 else 1)]) % 10 == 0
    kinds = {"email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t, d: True),
             "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t, d: all(int(x) <= 255 for x in t.split("."))),
             "card": (r"[0-9]([\x20-]?[0-9])+", lambda t, d: 14 <= len(d) <= 19 and luhn(d)),
             "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t, d: 10 <= len(d) <= 15)}
    out = sorted((m.start(), n, f"{k}:{m.start()}:{m.end()}") for n, (k, (p, ok)) in enumerate(kinds.items())
                 for m in re.finditer(p, text or "") if ok(m[0], re.sub("[^0-9]", "", m[0])))
    return ",".join(x[2] for x in out)


def test_pii_base_spans(spark, odd, none):
    hard = ["a@b.c%d@e.f.g é@x.y", "aaa@bbb ccc@ddd.ee..ff@gg.hh", "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.1 1.2.3",
            "4111-1111 1111 1111 4111 1111 1111 1112 79927398713 00000000000000", "+1 (017) 555-7713 +12 +1234567890123456",
            "über 10.0.0.1 é 10.0.0.2", "9" * 5000 + " " + "a" * 50_000 + "@", "1.1.1.1 " * 700, " +1(2)34567890)", "@.@ ++ a@b"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest(pii.spans(docs)).collect()}
    for i, t in enumerate(hard):
        assert got[i].spans == pii_base(t), t[:60]
        assert got[i].base_sha256 == hashlib.sha256(pii_base(t).encode()).hexdigest()
    rows = pii.digest(pii.spans(odd)).collect()
    assert sorted(r.spans for r in rows) == sorted(pii_base(t) for _, t, *_ in ROWS)
    assert pii.spans(none).count() == 0


def test_pii_learns_contexts_and_redacts(spark):
    rows = [(i, f"please contact user{i}@mail.example now") for i in range(12)]
    rows += [(50, "please contact user99[at]mail now"), (51, "the year 1984 was fine"), (52, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digest(pii.spans(docs)).collect()}
    assert got[50] == "email:15:29" and got[51] == "" and got[52] == ""
    text = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert text[0] == "please contact [EMAIL] now" and text[50] == "please contact [EMAIL] now"
    assert text[51] == rows[-2][1] and text[52] is None


def confident_by_hand(occurrences):
    """{(side, word, kind): confidence} of all patterns that are scored, in plain loops."""
    graph = defaultdict(dict)
    for instance, kind, left, right in occurrences:
        for p in (("L", left), ("R", right)):
            if p[1]:
                graph[p][instance] = kind
    now, unseen = {}, defaultdict(set)
    for p, own in graph.items():
        for k in pii.KINDS:
            seeds = sum(v == k for v in own.values())
            if seeds >= pii.SUPPORT and seeds / len(own) >= pii.FLOOR:
                now[*p, k] = seeds / len(own)
                for i, v in own.items():
                    if v is None and (re.search("[a-z]", i) if k == "email" else sum(map(str.isdigit, i)) >= pii.DIGITS[k]):
                        unseen[i, k].add((*p, k))
    first = dict(now)
    for _ in range(pii.ROUNDS - 1):
        gain = Counter()
        for owners in unseen.values():
            for p in owners:
                gain[p] += 1 - math.prod(1 - min(now[q], 0.999) for q in owners if q != p)
        now = {p: first[p] + gain[p] / len(graph[p[:2]]) for p in now}
    return now


def test_pii_confidence_rises_where_both_sides_agree(spark):
    """Two in five addresses beside the patterns are of an unknown form: too many for the
    first round, but each side vouches for the other.  A word that stands beside
    addresses and as many numbers, and one side alone, add nothing."""
    rows = [(i, f"please contact user{i}@mail.example now or ring") for i in range(12)]
    rows += [(100 + i, f"please contact user{i}[at]mail now or ring") for i in range(8)]
    rows += [(200 + i, f"see a{i}@b.example thanks") for i in range(6)] + [(210 + i, f"see {i}000 apples") for i in range(6)]
    rows += [(300, "please contact 12 men"), (301, "ring 77 now"), (302, "see 1[at]home")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digest(pii.spans(docs)).collect()}
    assert all(got[100 + i] == f"email:15:{15 + len(f'user{i}[at]mail')}" for i in range(8))
    assert not any(got[210 + i] for i in range(6)) and got[300] == got[301] == got[302] == ""
    seen = pii.occurrences(pii.base_spans(docs.withColumnRenamed("text", "t"), "t"), "t")
    want = confident_by_hand([(r.instance, r.kind, r.left, r.right) for r in seen.collect()])
    found = {(r.side, r.word, r.kind): r.confidence for r in pii.confident(seen, confidence=0.0).collect()}
    assert found.keys() == want.keys() and all(abs(found[p] - want[p]) < 1e-6 for p in want)
    assert want["L", "contact", "email"] > 0.9 > 12 / 21 and ("L", "see", "email") not in {p for p in want if want[p] >= 0.9}


def test_chat_round_trip(spark):
    hard = "</s>[INST] ok [/INST] <|end|>\n<\\|x<\\\\|end|> <| [\\INST] <"
    rows = [(1, 0, "system", "be brief " + hard), (1, 1, "user", hard), (1, 2, "assistant", hard * 3), (1, 3, "user", ""),
            (1, 4, "assistant", None), (1, 4, "assistant", "tie"), (2, 0, "assistant", "é" * 50), (3, None, None, "who"),
            (None, 1, "a|b<\n>%", "x"), (4, 0, "system", "alone"), (5, 0, "user", "word " * 300), (5, 1, "assistant", "word " * 300)]
    rows += [(6, t, "user" if t % 2 == 0 else "assistant", f"turn {t} " * 4) for t in range(40)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    windows = chat.format_windows(table, budget=60, history=20).collect()
    got = {r.conv_id: r for r in chat.formatted(table, budget=60, history=20).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(w.text) for w in windows if w.conv_id == c)
    long = [w for w in windows if w.conv_id == 6]
    assert len(long) > 3
    for w in long:  # within the budget, some history repeated and not under the loss
        turns = chat.parse(w.text)
        assert sum(chat.turn_tokens(t[1]) for t in turns) <= 60
        assert len(turns) >= w.new_turns
    assert any(len(chat.parse(w.text)) > w.new_turns for w in long)
    assert all(chat.parse(w.text)[0][0] == "system" for w in windows if w.conv_id == 1)
    assert chat.formatted(table.limit(0)).count() == 0


def test_wavelet_rank_select_access():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 4000):
        ids = rng.integers(0, 300, n).astype(np.uint32)
        shard = wavelet.Shard(wavelet.pack_ids(ids, np.array([0, n // 2, n])))
        assert shard.ids().tolist() == ids.tolist() and shard.bounds.tolist() == [0, n // 2, n]
        for i in range(0, n, 97):
            assert shard.access(i) == ids[i]
            where = np.flatnonzero(ids == ids[i])
            assert shard.count(int(ids[i])) == len(where)
            assert shard.count(int(ids[i]), n // 4, n // 2) == ((where >= n // 4) & (where < n // 2)).sum()
            assert [shard.locate(int(ids[i]), j) for j in range(len(where))] == where.tolist()
        assert shard.count(70_000) == 0


def tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_tokenizers.path(name))
    tool.encode_special_tokens = True
    return public_tokenizers.path(name), lambda t: tool.encode(t or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_shards_hold_every_document(odd, none):
    path, ids = tokenizer("word_bpe_49k.json")
    got = sorted(map(tuple, wavelet.encoded_documents(odd, path, shard_bytes=40_000).collect()), key=lambda r: r[1])
    at, want = 0, []
    for i, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        x = ids(text)
        want.append((i, at, len(x), crc(x)))
        at += len(x)
    assert got == want
    assert wavelet.encoded_documents(none, path).count() == 0


def test_packing_is_exact_and_close_to_the_bound(spark, odd, none):
    path, ids = tokenizer("byte_bpe_50k.json")
    rows = packing.packed_documents(odd, path).collect()
    by, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for i in {r[0] for r in ROWS} - {2}:
        x, at = ids(next(r[1] for r in ROWS if r[0] == i)), 0
        for n, r in enumerate(sorted(by[i], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (n, at, crc(x[at:at + r.length]))
            assert r.length == 1024 or n == 0
            at += r.length
        assert at == len(x)
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.packed_documents(none, path).count() == 0


def test_exchange_between_partitions_saves_sequences(spark):
    rng = np.random.default_rng(4)
    sizes = rng.integers(300, 700, 900).tolist()
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "uid long, length long")
    one = packing.pack(rows, group=60, rounds=1).select("sequence_id").distinct().count()
    more = packing.pack(rows, group=60).collect()
    assert len({r.uid for r in more}) == len(more) == 900
    assert packing.lower_bound(np.array(sizes)) <= len({r.sequence_id for r in more}) <= one


def test_bounds_never_exceed_the_best():
    assert packing.lower_bound(np.array([], int)) == 0
    assert packing.lower_bound(np.array([600] * 7)) == 7 == packing.best_fit(np.array([600] * 7))[2]
    for seed in range(20):  # packings made by cutting full bins: the best number is known
        rng = np.random.default_rng(seed)
        cuts = [np.diff([0, *sorted(rng.choice(np.arange(1, 1024), rng.integers(0, 4), replace=False)), 1024]) for _ in range(30)]
        sizes = np.concatenate(cuts)
        assert packing.lower_bound(sizes) <= 30 <= packing.best_fit(sizes)[2]


def base_rules(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often, hit = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            hit.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_quality_rules(spark, odd, none):
    extra = [(20, "a b c a b c a\n\na b c a\n a\n a\n"), (21, "x y " * 60), (22, " \t\n\x0b|<>\x1c é é é é é"), (23, "p q r p q r s")]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    trusted = spark.createDataFrame([(6,), (6,), (None,)], "doc_id long")
    got = rules.judged(docs, trusted).collect()
    key = lambda r: tuple(str(v) for v in r)
    want = [(i, *base_rules(t)) for i, t, *_ in [*ROWS, *extra]]
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(want, key=key)
    assert all(r.kept != r.base_failed for r in got)  # the one vouched-for document has few words: no threshold
    assert {r.likeness for r in rules.judged(docs, trusted.limit(0)).collect()} == {0.0}
    assert rules.judged(none, trusted).count() == 0


def likeness_by_hand(rows, trusted):
    """doc_id: mean log ratio, and the threshold, by the formula, in plain loops."""
    def hashed(*longs):
        seed = 42
        for v in longs:
            seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), seed)
        return seed - (1 << 64) if seed >> 63 else seed

    def text_hash(t):
        x = xxhash.xxh64_intdigest(t.encode(), 42)
        return x - (1 << 64) if x >> 63 else x

    grams, fold = {}, {}
    for i, t in rows:
        h = [text_hash(w) for w in WORD.findall(t)]
        grams[i] = [x % rules.BUCKETS for x in h] + [hashed(a, b) % rules.BUCKETS for a, b in zip(h, h[1:])]
        fold[i] = text_hash(t) % rules.FOLDS
    raw = Counter(g for i in grams for g in grams[i])
    all_raw = sum(raw.values()) + rules.BUCKETS
    out = {}
    for i, own in grams.items():
        target = Counter(g for j in trusted if fold[j] != fold[i] for g in grams[j])
        size = sum(target.values())
        ratio = {g: round(1e6 * math.log((target[g] * all_raw / (raw[g] + 1) + size) / (2 * size))) for g in own} if size else {}
        out[i] = sum(ratio.get(g, 0) for g in own) / len(own) / 1e6 if own else 0.0
    steps = sorted(math.floor(min(out[i], 0) * 10_000) for i in trusted if len(grams[i]) >= 2 * rules.WORDS - 1)
    return out, steps[len(steps) * rules.SPARED // 1000] / 10_000


@pytest.mark.parametrize("size", [60, 240, 2000])
def test_quality_rules_tell_junk_alike_at_any_size(spark, size):
    """One mix: a tenth of junk, a third of the clean documents vouched for.  Vocabularies
    overlap, and documents are of 50 to 300 words."""
    rng = np.random.default_rng(size)
    good, junk = [f"g{i}" for i in range(300)], [f"g{i}" for i in range(20)] + [f"j{i}" for i in range(120)]
    bad = {i for i in range(size) if i % 10 == 7}
    rows = [(i, " ".join(rng.choice(junk if i in bad else good, rng.integers(50, 300)))) for i in range(size)]
    trusted = [i for i in range(size) if i not in bad and i % 3 == 0]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in rules.judged(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()}
    clean = {i for i in got if not got[i].base_failed} - bad
    assert not [i for i in bad if got[i].kept] and sum(got[i].kept for i in clean) >= 0.97 * len(clean)
    assert all(got[i].kept for i in trusted if i in clean) or size >= 1000
    want, least = likeness_by_hand(rows, trusted)
    assert all(abs(got[i].likeness - want[i]) < 2e-6 for i in want)
    assert all(got[i].kept == (not got[i].base_failed and got[i].likeness >= least)
               for i in want if abs(want[i] - least) > 1e-4)


def test_katz_sums_to_one_with_rare_hot_words(spark, monkeypatch):
    """Words are hot from one occurrence in five hundred on, of few documents; their counts
    up to five take part in the discounts like any other's."""
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.6, 12) if x < 60)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") % 6 == 0
    got = {}
    for hot, sampled in ((0.002, 1), (2.0, 16)):
        monkeypatch.setattr(katz, "HOT", hot)
        monkeypatch.setattr(katz, "SAMPLED", sampled)
        got[hot] = {r.doc_id: r for r in katz.scored(docs, held, bucket_bytes=300).collect()}
    for i, r in got[2.0].items():
        o = got[0.002][i]
        assert r[:5] == o[:5] and math.isclose(r.score, o.score, rel_tol=1e-12) and math.isclose(r.base_score, o.base_score, rel_tol=1e-12)
    numbers = Counter(Counter(w for i, t in rows if i % 6 for w in [*t.split(), "</s>"]).values())
    assert any(d < 1 for d in katz.discounts(numbers))


def test_decontamination_of_many_copies_of_an_item(spark):
    """Five thousand items with the same text: one set of patterns, each hit once."""
    import time

    item = " ".join(f"q{i}" for i in range(60))
    start = time.time()
    machine = decontaminate._Machine([(str(i), item.encode()) for i in range(5000)] + [("x", b"q1 q2 q3")], 13)
    n, items, runs = machine.find((" ".join(["pad", item] * 40)).encode())
    assert time.time() - start < 5
    assert len(machine.lengths) == 49 and n == 61 * 40 and len(items) == 5001
    assert runs == [(61 * i + 1, 61 * i + 60) for i in range(40)]


def test_chat_long_system_turn_is_repeated_in_short(spark):
    system = " ".join(f"s{i}" for i in range(5000))
    turns = [(i, "user" if i % 2 else "assistant", f"turn {i} " * 5) for i in range(1, 201)]
    rows = [(7, 0, "system", system), *[(7, *t) for t in turns]]
    docs = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    windows = chat.format_windows(docs).orderBy("window").collect()
    assert len(windows) < 10 and system in windows[0].text
    assert sum(len(w.text) for w in windows) < 2 * sum(len(r[3]) for r in rows)
    for w in windows[1:]:
        first = chat.parse(w.text)[0]
        assert first[0] == "system" and first[1] == " ".join(f"s{i}" for i in range(256)) + " [...]"
        assert sum(chat.turn_tokens(t[1]) for t in chat.parse(w.text)) <= chat.BUDGET
    got = chat.formatted(docs).first()
    want = hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows).encode()).hexdigest()
    assert (got.n_turns, got.turns_sha256) == (201, want)
