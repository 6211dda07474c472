"""Operator 8: quality classification by importance resampling.

Two generative models of hashed word n-grams (single words and punctuation runs, and adjacent pairs) are compared: one of target text,
one of raw text. A document's weight is the log of the ratio of its probabilities under both. Documents are sampled
without replacement with probability proportional to their weights, by Gumbel top-k: random Gumbel
numbers are added to the log weights and the k largest sums are kept.

k isn't a quota set beforehand: it's the number of all documents that reach the weight that best separates labelled good documents
from bad ones, so the sample has room for every document that looks like the target.

The raw model counts all documents. The target model counts the documents of a bounded sample of one half of the good labels;
the other half and the bad labels only set the threshold, so it's right for documents that the model hasn't seen.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.llm.common import cut, row_id, slices, text_bytes

#: Buckets of hashed n-grams.
BUCKETS = 1 << 14
#: Good labelled documents that the target model is fitted on, at most: of those whose doc_id has an even hash, the ones with the smallest.
TARGET_SAMPLE = 20_000
#: Words whose hashes a worker remembers.
MEMO_WORDS = 100_000
#: N-grams of the raw model's distribution added to the target's count of each bucket, so that rare n-grams say little.
SMOOTHING = 5.0
#: Bins of log weights up to e^20 on each side of 0, on a scale that is linear near 0 and logarithmic far from it.
BINS = 1 << 12
#: Times that the bin in which the sample ends is divided into BINS, at most; its rows are ordered one by one after that.
LEVELS = 3

_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]+")


class Hashes(dict):
    """Packed 32-bit hashes of the tokens of a white-space separated word: letters and digits, and what is between them."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > MEMO_WORDS:
            self.clear()
        out = self[word] = np.array([zlib.crc32(t) for t in _TOKEN.findall(word)], "<u4").tobytes()
        return out


_memo = Hashes()


def grams(raw: bytes, buckets: int) -> np.ndarray:
    """The buckets of a text's n-grams, repeats included."""
    h = np.frombuffer(b"".join(map(_memo.__getitem__, raw.split())), "<u4").astype(np.uint64)
    two = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(33)
    return np.concatenate([h % np.uint64(buckets), two % np.uint64(buckets)]).astype(np.int64)


def fit(docs: DataFrame, target: list[int], buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's log ratio: its share of the n-grams of documents in target, over its share of all documents'."""
    chosen = np.array(sorted(target), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, buckets), np.int64)
        for batch in slices(batches):
            ids = np.array([-1 if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            null = np.array([x is None for x in batch.column(0).to_pylist()], bool)
            good = np.isin(ids, chosen) & ~null
            for is_target, raw in zip(good.tolist(), text_bytes(batch.column(1)), strict=True):
                seen = np.bincount(grams(raw, buckets), minlength=buckets)
                counts[0] += seen
                if is_target:
                    counts[1] += seen
        used = np.flatnonzero(counts[0])
        yield pa.record_batch([pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])], ["bucket", "raw", "target"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "bucket long, raw long, target long")
    sums = rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # a row a bucket at most
    raw, seen = np.zeros(buckets), np.zeros(buckets)
    for r in sums:
        raw[r.bucket], seen[r.bucket] = r.raw, r.target
    expected = raw * (seen.sum() / max(raw.sum(), 1.0))
    return np.log((seen + SMOOTHING) / (expected + SMOOTHING))


def weigh(docs: DataFrame, ratios: np.ndarray, rid: str | None = None) -> DataFrame:
    """(rid, doc_id, n_grams, weight) of each document; weight is the log importance weight."""
    buckets = len(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            g = [grams(raw, buckets) for raw in text_bytes(batch.column(2))]
            weights = [float(ratios[x].sum()) for x in g]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([len(x) for x in g], pa.int64()), pa.array(weights, pa.float64())], ["rid", "doc_id", "n_grams", "weight"])

    rows = docs.select(row_id(rid).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"rid {rows.schema['rid'].dataType.simpleString()}, doc_id long, n_grams long, weight double")


def _scaled(x: Column) -> Column:
    """x on the scale of bins, which are narrow near 0."""
    return F.signum(x) * F.log1p(F.abs(x)) / F.lit(20.0) * F.lit(BINS)


def _bin(x: Column) -> Column:
    """A monotone bin number of x."""
    return F.floor(_scaled(x)).cast("int")


def threshold(weighed: DataFrame, labels: DataFrame) -> int | None:
    """The bin of weights from which documents are taken for good, from all labelled documents but those meant for the target.

    Of the bins that best separate good from bad labels (share of good ones kept less share of bad ones kept, within
    one percent of the best) it's the lowest, as it costs least good text. None without both labels.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    unseen = known.filter((F.col("quality") <= 0) | (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1))
    counts = weighed.join(unseen, "doc_id").groupBy(_bin(F.col("weight")).alias("bin")).agg(F.count_if(F.col("quality") > 0).alias("good"), F.count_if(F.col("quality") <= 0).alias("bad")).collect()  # a row a bin
    good, bad = sum(r.good for r in counts), sum(r.bad for r in counts)
    if not good or not bad:
        return None
    best: list[tuple[float, int]] = []
    g, b = good, bad
    for r in sorted(counts, key=lambda r: r.bin):
        best.append((g / good - b / bad, r.bin))
        g, b = g - r.good, b - r.bad
    top = max(best)[0]
    i = next(i for i, (gain, _) in enumerate(best) if gain >= top - 0.01)
    return best[i][1] if not i else (best[i][1] + best[i - 1][1]) // 2 + 1  # halfway to the labelled documents below


def resample(docs: DataFrame, labels: DataFrame, seed: int = 8, buckets: int = BUCKETS, target_sample: int = TARGET_SAMPLE, rid: str | None = None) -> DataFrame:
    """Which documents importance resampling keeps: rid, doc_id, n_grams, weight, kept.

    docs has doc_id and text, labels has doc_id and quality (over 0 is good); other columns are ignored. rid is the column of docs
    of that name, which tells rows apart, or a number for each row. A null text counts as empty: weight 0. Repeated labels of a
    document count once, the best of them. Without good labels for both halves or without bad ones there is no target or no threshold:
    every document is kept then. The random numbers are hashes of doc_id, n_grams and seed, so reruns agree; at equal sums the row that comes first is
    kept. An empty table gives an empty result.
    """
    good = labels.filter("doc_id is not null and quality > 0").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    even = good.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    target = [r.doc_id for r in even.orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_sample).collect()]  # the bounded sample
    weighed = cut(weigh(docs, fit(docs, target, buckets), rid))
    floor = threshold(weighed, labels) if target else None
    if floor is None:
        return weighed.withColumn("kept", F.lit(True))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "n_grams", F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    x = weighed.withColumn("__sum", F.col("weight") - F.log(-F.log(u))).withColumn("__at", _scaled(F.col("__sum")))
    k = weighed.filter(_bin(F.col("weight")) >= floor).count()
    columns = [*weighed.columns, "kept"]
    kept = []
    # the k largest sums: whole bins from the top, and the rest of k from the bin in which it ends, which is divided again
    for _ in range(LEVELS):
        x = x.withColumn("__bin", F.floor("__at").cast("int"))
        bins = x.groupBy("__bin").agg(F.count("*").alias("n")).collect()  # a row a bin
        above, edge = 0, None
        for r in sorted(bins, key=lambda r: -r["__bin"]):
            if above + r.n > k:
                edge = r["__bin"]
                break
            above += r.n
        kept.append(x.withColumn("kept", F.lit(True) if edge is None else F.col("__bin") > edge).filter(F.lit(True) if edge is None else F.col("__bin") != edge).select(columns))
        if edge is None:
            break
        x, k = cut(x.filter(F.col("__bin") == edge).withColumn("__at", (F.col("__at") - F.col("__bin")) * BINS)), k - above
    else:
        order = Window.partitionBy("__bin").orderBy(F.desc("__sum"), "rid")
        kept.append(x.withColumn("kept", F.row_number().over(order) <= k).select(columns))
    out = kept[0]
    for part in kept[1:]:
        out = out.unionByName(part)
    return out
