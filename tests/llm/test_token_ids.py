import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spanlink.llm import token_ids as T
from tests.llm.data import docs

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=60))
def test_coding_round_trip(values):
    v = np.array(values, "<u4")
    control, data = T.pack(v)
    assert len(control) == -(-len(v) // 4)
    assert T.unpack(control, data, len(v)).tolist() == v.tolist()


def test_words_have_the_ids_of_whole_texts():
    rnd = random.Random(3)
    parts = ["The", "ther***", "éau", "İ", "Σίσυφος", "it's", "'ll", "12", "x1y", "!!", "<|endoftext|>", "<|ENDOFTEXT|>", "é", "漢字", "😀", "\x1c", "\xa0", "ſ", "W̊", "don't.", "a.b", ""]
    t, memo, dtype = T.load(PATH)
    plain = Tokenizer.from_file(PATH)
    for _ in range(1500):
        text = "".join(rnd.choice(parts) + rnd.choice([" ", "", "\n", "  ", "\t", "\x0b"]) for _ in range(rnd.randint(0, 8)))
        got = np.frombuffer(b"".join(map(memo.__getitem__, text.encode().split())), dtype).tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_files_round_trip(spark, tmp_path, monkeypatch):
    texts = ["Hello there, hello.", None, "", "Zürich " * 3000, "Hello there, hello.", "a b c"]
    ids = [5, None, 2, 9, 5, -4]
    monkeypatch.setattr(T, "BLOCK_IDS", 50)
    T.write_ids(docs(spark, texts, ids=ids), str(tmp_path / "x"), PATH)
    plain = Tokenizer.from_file(PATH)
    want = sorted(((i is not None, i or 0), plain.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in zip(ids, texts, strict=True))
    got = sorted(T.read_ids(spark, str(tmp_path / "x"), with_ids=True).collect(), key=lambda r: r.start)
    start = 0
    for r, ((known, i), w) in zip(got, want, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i if known else None, start, len(w), w)
        assert r.ids_crc32 == zlib.crc32(np.array(w, "<u4").tobytes())
        start += len(w)


def test_frequent_ids_have_low_ranks(spark, tmp_path):
    T.write_ids(docs(spark, ["the the the rain", "the rain"]), str(tmp_path / "x"), PATH)
    ranks = [r.id for r in spark.read.parquet(str(tmp_path / "x/ranks")).orderBy("rank").collect()]
    plain = Tokenizer.from_file(PATH)
    the, rain = plain.encode("the", add_special_tokens=False).ids + plain.encode("rain", add_special_tokens=False).ids
    assert ranks == [the, *sorted([2, rain])]


def test_no_documents(spark, tmp_path):
    T.write_ids(docs(spark, []), str(tmp_path / "x"), PATH)
    assert T.read_ids(spark, str(tmp_path / "x")).collect() == []


def test_damage_is_noticed(spark, tmp_path):
    T.write_ids(docs(spark, ["one two three"]), str(tmp_path / "x"), PATH)
    from pyspark.sql import functions as F

    spark.read.parquet(str(tmp_path / "x/blocks")).withColumn("crc", F.col("crc") + 1).write.parquet(str(tmp_path / "y/blocks"))
    spark.read.parquet(str(tmp_path / "x/ranks")).write.parquet(str(tmp_path / "y/ranks"))
    with pytest.raises(Exception, match="damaged"):
        T.read_ids(spark, str(tmp_path / "y")).collect()
