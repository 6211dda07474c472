import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spanlink.llm import bpe
from tests.llm.data import docs

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def same(texts):
    for text, raw in zip(texts, bpe.vocabulary(PATH).encode(texts), strict=True):
        ids = PLAIN.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids, repr(text)
        assert bpe.vocabulary(PATH).decode(np.array(ids, "<u4")) == PLAIN.decode(ids, skip_special_tokens=False)


def test_mixed_texts():
    rnd = random.Random(1)
    parts = [*"ab'st  \n\t  \x1c\x85é漢😀19.,!<|", "<|endoftext|>", " the", "'ll", "aaaa", "    ", "\r\n", "​", "é"]
    same(["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(2500)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=5))
def test_any_texts(texts):
    same([t.encode("utf-8", "ignore").decode() for t in texts])


@pytest.mark.parametrize("limit", [0, 10**9])
def test_both_ways_of_merging(monkeypatch, limit):
    monkeypatch.setattr(bpe, "LONG_LISTS", limit)
    v = bpe.Vocabulary(PATH)
    pieces = [b"a" * 301, b"abababab", b" there", b"e", "éàü".encode() * 40, b"the" * 100, bytes(range(256))]
    for p, raw in zip(pieces, v.merge(pieces), strict=True):
        chars = {b: c for c, b in bpe.byte_symbols().items()}
        want = [t.id for t in PLAIN.model.tokenize("".join(chars[x] for x in p))]
        assert np.frombuffer(raw, "<u4").tolist() == want
    assert v.merge([]) == []


def test_small_memory(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    same(["one two three four five six seven"] * 3 + ["one  two", " x", ""])


def test_bytes_that_are_no_text():
    assert bpe.vocabulary(PATH).decode(np.array([PLAIN.encode("é").ids[0], 128], "<u4")) == PLAIN.decode([PLAIN.encode("é").ids[0], 128])


def test_frames(spark):
    texts = ["Hello <|endoftext|> there", None, "", "word " * 60000, "Hello <|endoftext|> there"]
    d = docs(spark, texts, ids=[4, None, 2, 1, 4])
    got = bpe.bpe_decode(bpe.bpe_encode(d, PATH, packed=True), PATH).collect()
    once = bpe.bpe_encode(d, PATH, packed=True, decoded=True).collect()
    assert sorted((r.doc_id or -1, r.ids, r.text) for r in got) == sorted((r.doc_id or -1, r.ids, r.text) for r in once)
    assert sorted((r.doc_id or -1, r.text) for r in got) == sorted((i or -1, t or "") for i, t in zip([4, None, 2, 1, 4], texts, strict=True))
    lists = {r.doc_id: r.ids for r in bpe.bpe_encode(d, PATH).collect()}
    assert lists[4] == PLAIN.encode(texts[0], add_special_tokens=False).ids and lists[None] == []
    assert bpe.bpe_encode(docs(spark, []), PATH).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
