"""Operator 4: exact deduplication by deterministic block naming.

A normalised text is cut into blocks of a fixed size. Equal blocks get the same integer name, different
blocks different ones: distinct blocks are sorted, and a block's name is its place. Then adjacent names
are paired and the distinct pairs are sorted and named in the same way, until one name is left of each
document. With the number of its blocks, that name is the document's identity, without collisions.

A block or pair that many documents share is sent to be named once by each task, not once by each document.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.llm.common import cut, delete, shared_dir, skewed_join, slices, text_bytes

#: Bytes of a block.
BLOCK = 1 << 14
#: What normalisation deletes.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of distinct blocks that a task holds before it starts a new dictionary.
DICTIONARY = 64 << 20

_PIECES = "part int, rid long, key {key}, doc_id long, n_chars long, text_sha256 string, blocks array<bigint>, k long, block binary"


def _pieces(docs: DataFrame, block: int) -> DataFrame:
    """A row a document of (doc_id, text, key) with the numbers of its blocks in its task's dictionary, and a row an entry (k, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        numbers: dict[bytes, int] = {}
        held, last, rid = 0, 0, part << 33
        for batch in slices(batches):
            rows: list[tuple] = []
            new: list[tuple[int, bytes]] = []
            for doc, raw, key in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                text = raw.translate(None, SPACES)
                names = []
                for at in range(0, len(text) or 1, block):
                    piece = text[at : at + block]
                    k = numbers.get(piece)
                    if k is None:
                        k = numbers[piece] = last
                        new.append((k, piece))
                        last, held = last + 1, held + len(piece)
                    names.append(k)
                n_chars = len(raw.decode("utf-8", "replace"))
                rows.append((rid, doc, n_chars, hashlib.sha256(text).hexdigest(), names, key))
                rid += 1
            if held > DICTIONARY:
                numbers, held = {}, 0
            a, b = len(rows), len(new)
            yield pa.record_batch(
                [
                    pa.array([part] * (a + b), pa.int32()),
                    pa.array([r[0] for r in rows] + [None] * b, pa.int64()),
                    pa.array([r[5] for r in rows] + [None] * b, batch.column(2).type),
                    pa.array([r[1] for r in rows] + [None] * b, pa.int64()),
                    pa.array([r[2] for r in rows] + [None] * b, pa.int64()),
                    pa.array([r[3] for r in rows] + [None] * b, pa.string()),
                    pa.array([r[4] for r in rows] + [None] * b, pa.list_(pa.int64())),
                    pa.array([None] * a + [x[0] for x in new], pa.int64()),
                    pa.array([None] * a + [x[1] for x in new], pa.binary()),
                ],
                ["part", "rid", "key", "doc_id", "n_chars", "text_sha256", "blocks", "k", "block"],
            )

    return docs.mapInArrow(run, _PIECES.format(key=docs.schema["key"].dataType.simpleString()))


def _named_blocks(entries: DataFrame) -> DataFrame:
    """(part, k, name) of dictionary entries: equal blocks meet in one task, sorted; a name is the place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, before = (TaskContext.get().partitionId() << 40) - 1, None
        for batch in slices(batches, 1024):
            names = []
            for block in batch.column(2).to_pylist():
                if block != before:
                    name, before = name + 1, block
                names.append(name)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(names, pa.int64())], ["part", "k", "name"])

    return entries.repartition("block").sortWithinPartitions("block").mapInArrow(run, "part int, k long, name long")


def identities(docs: DataFrame, block: int = BLOCK, rid: str | None = None) -> DataFrame:
    """(rid, key, doc_id, n_chars, text_sha256, n_blocks, name): equal normalised texts have equal (n_blocks, name).

    rid is a number for each row; key is the value of the column rid, null without one.
    """
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/blocks-{uuid.uuid4()}"
    key = F.lit(None).cast("long") if rid is None else F.col(rid)
    pieces = _pieces(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), key.alias("key")), block)
    pieces.write.parquet(path)
    pieces = spark.read.schema(pieces.schema).parquet(path)
    entries = pieces.filter("block is not null").select("part", "k", "block")
    names = cut(_named_blocks(entries))
    rows = pieces.filter("rid is not null")
    about = cut(rows.select("rid", "key", "doc_id", "n_chars", "text_sha256", F.size("blocks").alias("n_blocks")))
    at = rows.select("rid", "part", F.posexplode("blocks").alias("i", "k"))
    state = cut(skewed_join(at, names, ["part", "k"]).select("rid", F.col("i").cast("long").alias("i"), "name"))
    delete(spark, path)
    most = about.agg(F.max("n_blocks")).first()[0] or 0
    done = state.join(about.filter("n_blocks = 1").select("rid"), "rid") if most > 1 else state
    done = done.select("rid", "name")
    if most > 1:
        left = cut(state.join(about.filter("n_blocks > 1").select("rid"), "rid", "left_semi"))
        while most > 1:
            # adjacent names pair up; a last one without a partner pairs with -1
            pairs = left.groupBy("rid", F.shiftright("i", 1).alias("i")).agg(F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
            pairs = cut(pairs)
            sorted_pairs = pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
            names = cut(sorted_pairs.withColumn("name", F.monotonically_increasing_id()))
            left = cut(skewed_join(pairs, names, ["a", "b"]).select("rid", "i", "name"))
            most = (most + 1) // 2
        done = done.unionByName(left.select("rid", "name"))
    return about.join(done, "rid")


def exact_dedup(docs: DataFrame, block: int = BLOCK, rid: str | None = None) -> DataFrame:
    """Finds documents whose texts are identical once white space (space and U+0009 to U+000D) is deleted.

    docs has doc_id and text; other columns are ignored. A row a document, dropped ones too: rid (the column of that name, which
    tells rows apart, or a number for each row), doc_id, keep_id, group_size, kept, text_sha256 (of
    the normalised text). Of equal texts the row with the most code points in the original text stays, then
    the one with the smallest doc_id (null last), then the first row. A null text counts as empty; empty
    texts are equal to each other. An empty table gives an empty result.
    """
    ids = cut(identities(docs, block, rid))
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("keep_id"), F.col("rid").alias("keep_rid")))
    groups = ids.groupBy("n_blocks", "name").agg(F.count("*").alias("group_size"), best.alias("best"))
    groups = cut(groups.select("n_blocks", "name", "group_size", "best.keep_id", "best.keep_rid"))
    out = skewed_join(ids, groups, ["n_blocks", "name"])
    return out.select(F.col("rid" if rid is None else "key").alias("rid"), "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")
