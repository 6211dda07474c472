"""Operator 9: sharding by rendezvous hashing over weighted shards, in DataFrame operations only.

A record's key and a shard's number give a random number u; the record goes to the shard with the
largest -weight / ln(u). A shard that is added can only win records, so it takes rows only into itself, and
1 / (n + 1) of them at equal weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.llm.common import cut

#: Rows of a part of a shard, on average and at most, in which rows are numbered on their own.
PART_ROWS = 1 << 14


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of a key: the number of the weight that wins."""
    if not weights:
        raise ValueError("at least one shard is needed")

    def score(i: int, weight: float) -> Column:
        h = F.xxhash64(key, F.lit(i).cast("int"))
        u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
        return F.struct((F.lit(float(weight)) / -F.log(u)).alias("score"), h.alias("h"), F.lit(-i).alias("shard"))

    if len(set(weights)) == 1:  # the largest hash wins then, as the score rises with it
        best = F.greatest(*[F.struct(F.shiftrightunsigned(F.xxhash64(key, F.lit(i).cast("int")), 1).alias("h"), F.lit(-i).alias("shard")) for i in range(len(weights))])
    else:
        best = F.greatest(*[score(i, w) for i, w in enumerate(weights)])
    return (-best["shard"]).cast("int")


def shard(docs: DataFrame, n_shards: int = 40, weights: list[float] | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Puts rows into shards by doc_id alone: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    docs has doc_id and text; other columns are ignored. size is the text's UTF-8 bytes plus 16, text_crc32 the
    CRC-32 of those bytes; a null text has none. weights are the shards' shares (equal if not given); the shard
    added for grown_shard has the mean weight. A null doc_id is a key like any other. slot numbers the rows of a shard from
    0 without gaps: rows are numbered in parts of the shard by the hash of doc_id and text, and each part starts where
    the one before it ends. Rows of the same doc_id and text have neighbouring slots. An empty table gives an empty result.
    """
    weights = [1.0] * n_shards if weights is None else list(weights)
    raw = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    key = F.col("doc_id").cast("long")
    rows = docs.select(key.alias("doc_id"), (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    grown = [*weights, sum(weights) / len(weights)]
    k = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = rows.withColumn("shard", rendezvous(k, weights)).withColumn("grown_shard", rendezvous(k, grown))
    rows = cut(rows)
    parts = -(-rows.count() // (len(weights) * part_rows)) or 1
    rows = rows.withColumn("__part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(parts)).cast("int"))
    counts = rows.groupBy("shard", "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    order = Window.partitionBy("shard", "__part").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("__k", F.row_number().over(order) - 1)
    out = numbered.join(starts, ["shard", "__part"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("__start") + F.col("__k")).cast("long").alias("slot"), "grown_shard")
