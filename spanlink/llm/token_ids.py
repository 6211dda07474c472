"""Operator 1: token ids in a binary file format, frequency-ranked and byte-aligned.

Each text is encoded with a public tokenizer, and an end id closes each document. Ids are replaced by
their frequency rank, so that frequent ids need one byte; a rank takes one to four bytes, and the lengths
of four ranks share one control byte. Controls and data are kept apart, which lets numpy decode whole
blocks by table lookup.

Files of a dataset at ``path``: ``ranks`` (rank, id) and ``blocks``, Parquet files whose rows are blocks of
whole documents in ascending doc_id order: part and seq (place of the block), before (ids of the part in
front of the block), doc_ids and lengths (of its documents), control and data (the coded ranks) and crc
(CRC-32 of control and data, checked when read).
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.llm.common import cut, slices, text_bytes

#: Ids in a block at least, before it is closed at the end of a document.
BLOCK_IDS = 1 << 18
#: Words whose ids a worker remembers.
MEMO_WORDS = 400_000

# ---- coding -----------------------------------------------------------------------------------------

_COLUMNS = np.arange(4)
_CODES = (np.arange(256)[:, None] >> (2 * _COLUMNS)) & 3  # of the four ranks of a control byte
_SIZES = (_CODES + 1).sum(1)
_STARTS = np.cumsum(_CODES + 1, axis=1) - (_CODES + 1)
#: Where each of the 16 bytes of four ranks is, from the start of their data; -1 is a zero byte.
_LOOKUP = np.where(_COLUMNS[None, None, :] <= _CODES[:, :, None], _STARTS[:, :, None] + _COLUMNS[None, None, :], -1).reshape(256, 16)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = np.zeros(-(-len(values) // 4) * 4, "<u4")
    v[: len(values)] = values
    codes = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    data = v.view(np.uint8).reshape(-1, 4)[_COLUMNS[None, :] <= codes[:, None]]
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values that pack() has coded."""
    c = np.frombuffer(control, np.uint8)
    if not len(c):
        return np.empty(0, "<u4")
    sizes = _SIZES[c]
    source = np.frombuffer(data + b"\0", np.uint8)  # the last byte is the zero that _LOOKUP's -1 means
    look = _LOOKUP[c]
    at = np.where(look < 0, len(data), look + (np.cumsum(sizes) - sizes)[:, None])
    return source[at].view("<u4").reshape(-1)[:n]


# ---- encoding ---------------------------------------------------------------------------------------

_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordIds(dict):
    """Ids (bytes, little-endian) of white-space separated words, filled as they are met.

    Right for tokenizers whose first steps turn white space into breaks between words, so that a word's
    ids don't depend on its neighbours (``splits_at_spaces``). Letters followed by punctuation are
    split here the way the tokenizer's own pattern does it; all other words go through it whole.
    """

    def __init__(self, tokenizer, dtype: str):
        super().__init__()
        self.tokenizer, self.dtype, self.parts = tokenizer, dtype, {}
        from tokenizers import pre_tokenizers

        byte = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_chars = lambda s: "".join(x for x, _ in byte.pre_tokenize_str(s))

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > MEMO_WORDS:
            self.clear()
        if len(self.parts) > MEMO_WORDS:
            self.parts.clear()
        text = word.decode("utf-8", "replace")
        if m := _WORD.fullmatch(text):
            ids = self.stem(m[1].lower()) + (self.whole(m[2]) if m[2] else b"")
        else:
            ids = self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self[word] = ids
        return ids

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def stem(self, letters: str) -> bytes:
        ids = self.parts.get(letters)
        if ids is None:
            chars = letters if letters.isascii() else self.byte_chars(letters)
            ids = self.parts[letters] = self.pack([t.id for t in self.tokenizer.model.tokenize(chars)])
        return ids

    def whole(self, text: str) -> bytes:
        ids = self.parts.get(text)
        if ids is None:
            ids = self.parts[text] = self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return ids


def splits_at_spaces(tokenizer) -> bool:
    """Whether the tokenizer normalises, lower-cases and drops white space as WordIds expects it."""
    import json

    t = json.loads(tokenizer.to_str())
    normal = [x["type"] for x in (t.get("normalizer") or {}).get("normalizers", [])]
    first = ((t.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    pattern = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    return normal == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": pattern} and first.get("invert") is True


_loaded: dict[str, tuple] = {}


def load(path: str) -> tuple:
    """Tokenizer, memo of words or None, and the type its ids fit in, once a worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        dtype = "<u2" if max(t.get_vocab(with_added_tokens=True).values()) < 1 << 16 else "<u4"
        _loaded[path] = t, WordIds(t, dtype) if splits_at_spaces(t) else None, dtype
    return _loaded[path]


def encode(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """(doc_id, ids, counts): a row a document with its ids as packed bytes, and a row a task with counts.

    A row of counts has null ids; its n_tokens are an id's number of uses, its doc_id is the id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, memo, dtype = load(tokenizer)
        end = b"" if end_id is None else np.array([end_id], dtype).tobytes()
        counts = np.zeros(1 << 16, np.int64)
        for batch in slices(batches):
            out = []
            for raw in text_bytes(batch.column(1)):
                if memo is not None:
                    ids = b"".join(map(memo.__getitem__, raw.split())) + end
                else:
                    ids = np.array(t.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids, dtype).tobytes() + end
                out.append(ids)
            seen = np.bincount(np.frombuffer(b"".join(out), dtype), minlength=len(counts))
            if len(seen) > len(counts):
                counts = np.pad(counts, (0, len(seen) - len(counts)))
            counts += seen
            n = np.array([len(x) for x in out], np.int64) // np.dtype(dtype).itemsize
            yield pa.record_batch([batch.column(0), pa.array(n), pa.array(out, pa.binary())], ["doc_id", "n_tokens", "ids"])
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used), pa.array(counts[used]), pa.nulls(len(used), pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


# ---- files ------------------------------------------------------------------------------------------

_BLOCKS = "part int, seq int, before long, n_tokens long, doc_ids array<bigint>, lengths array<bigint>, control binary, data binary, crc long"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2) -> None:
    """Encodes the texts of docs (doc_id, text; other columns are ignored) and writes them to path.

    A null text counts as empty and has the end id only. Documents with a null doc_id come first, those
    with the same doc_id follow each other in the order of a hash of their ids. An empty table gives files
    without blocks.
    """
    spark = docs.sparkSession
    rows = cut(encode(docs, tokenizer, end_id))
    counts = rows.filter("ids is null").groupBy(F.col("doc_id").alias("id")).agg(F.sum("n_tokens").alias("n"))
    ranked = [r.id for r in counts.orderBy(F.desc("n"), "id").collect()]  # one row an id of the vocabulary at most
    spark.createDataFrame(list(enumerate(ranked)), "rank int, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max(ranked, default=0) + 1, "<u4")
    rank_of[ranked] = np.arange(len(ranked))
    dtype = "<u2" if len(rank_of) <= 1 << 16 and load(tokenizer)[2] == "<u2" else load(tokenizer)[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        texts: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            values = np.frombuffer(b"".join(texts), dtype)
            control, data = pack(rank_of[values])
            lengths = [len(x) // np.dtype(dtype).itemsize for x in texts]
            crc = zlib.crc32(data, zlib.crc32(control))
            row = {"part": [part], "seq": [seq], "before": [before], "n_tokens": [len(values)], "doc_ids": [list(ids)], "lengths": [lengths], "control": [control], "data": [data], "crc": [crc]}
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64()]
            return pa.record_batch([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], list(row))

        for batch in slices(batches):
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc)
                texts.append(raw)
                size += len(raw) // np.dtype(dtype).itemsize
                if size >= BLOCK_IDS:
                    yield block()
                    seq, before, size = seq + 1, before + size, 0
                    ids, texts = [], []
        if ids:
            yield block()

    ordered = rows.filter("ids is not null").select("doc_id", "ids", F.xxhash64("ids").alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "ids").mapInArrow(run, _BLOCKS).write.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Reads a dataset back: doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, if asked for, ids.

    ids_crc32 is over the ids as little-endian unsigned 32-bit integers. A damaged block raises ValueError.
    """
    ranked = [r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]  # bounded by the vocabulary
    id_of = np.array(ranked, "<u4")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    starts, total = {}, 0
    for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():  # a row a file
        starts[r.part], total = total, total + r.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            if zlib.crc32(row["data"], zlib.crc32(row["control"])) != row["crc"]:
                raise ValueError(f"block {row['part']}/{row['seq']} is damaged")
            ids = id_of[unpack(row["control"], row["data"], row["n_tokens"])] if row["n_tokens"] else np.empty(0, "<u4")
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), row["lengths"], strict=True)]
            out = {"doc_id": pa.array(row["doc_ids"], pa.int64()), "start": pa.array(starts[row["part"]] + row["before"] + ends - lengths), "n_tokens": pa.array(lengths), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int64)))
            yield pa.record_batch(list(out.values()), list(out))

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<bigint>" * with_ids
    return blocks.mapInArrow(run, schema)
