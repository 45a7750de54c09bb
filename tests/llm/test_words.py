"""Byte helpers against plain Python."""

import re

import numpy as np
from hypothesis import given, settings, strategies as st

from harborline.llm import encode, words

ANY = st.lists(st.text(alphabet=st.sampled_from("aB z\t\n\x0b.é　 #1"), max_size=40), max_size=6)


@settings(max_examples=60, deadline=None)
@given(ANY)
def test_spans_and_hashes_agree_with_a_regular_expression(texts):
    raw = [t.encode() for t in texts]
    hashes, counts = words.word_hashes(raw)
    plain = [re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
    assert counts.tolist() == [len(w) for w in plain]
    flat = [w for doc in plain for w in doc]
    assert len({h: w for h, w in zip(hashes.tolist(), flat)}) == len(set(flat))
    assert len(set(zip(hashes.tolist(), flat))) == len(set(flat))


def test_long_words_and_chunks():
    texts = [b"x" * 300 + b" y", b"x" * 300, b"", b"y " * 10]
    hashes, counts = words.word_hashes(texts)
    assert counts.tolist() == [2, 1, 0, 10]
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3]
    assert list(words.chunks(texts, 302)) == [(0, 1), (1, 3), (3, 4)]
    assert list(words.chunks([])) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB z\t\n.é　 \u0085#1's\x1c\x01"), max_size=30), max_size=5))
def test_pieces_encode_like_whole_texts(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    for name, pieces in (("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaced")):
        plain = Tokenizer.from_file(public_tokenizers.path(name))
        plain.encode_special_tokens = True
        got = []
        for _, _, ids, bounds in encode.encoder(public_tokenizers.path(name), pieces).encode([t.encode() for t in texts]):
            got += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", " ", "  ", "\t", "ab", "é"]),
                         max_size=6).map("".join), max_size=5))
def test_special_tokens_encode_like_the_plain_call(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    for name, pieces in (("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaced")):
        plain, got = Tokenizer.from_file(public_tokenizers.path(name)), []
        for _, _, ids, bounds in encode.encoder(public_tokenizers.path(name), pieces).encode([t.encode() for t in texts]):
            got += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_with_end():
    ids, bounds = encode.with_end(np.array([5, 6, 7]), np.array([0, 2, 2, 3]), 2)
    assert ids.tolist() == [5, 6, 2, 2, 7, 2] and bounds.tolist() == [0, 3, 4, 6]
