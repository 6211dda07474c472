"""Operator 5: SimHash near-duplicates by segment-popcount embedding.

A 64-bit fingerprint is embedded as the bit counts of its 16 segments of four bits. Flipping a bit changes one
count by one, so the Manhattan distance of two embeddings is never above the fingerprints' Hamming
distance. The embeddings lie on a grid; two of them are within distance 2 exactly if they share a grid
point within distance 1 of both, which makes the range join an equality join on grid points.

Fingerprints without any partner on the grid are done. The others are verified exactly in the same way:
two fingerprints differ in at most 2 bits exactly if some bit string differs from both in at most one. All that
share such a string, 65 at most, are linked to the smallest of them. No pairs of a group are listed, whatever its size.

For wider distances the segments are divided into parts, of which one differs in at most 2 bits; the join is made for each part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlink.llm.common import cut, skewed_join, slices, text_bytes
from spanlink.llm.graph import components

#: Seed of the shingles' XXH64.
SEED = 42
#: Shingles counted at once.
CHUNK = 1 << 16
#: Segments of a fingerprint, four bits each.
SEGMENTS = 16


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = np.ascontiguousarray(hashes[at : at + CHUNK]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return counts


def majority(counts: np.ndarray, n: int) -> int:
    """The fingerprint of n hashes with these bit_counts()."""
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(words: list[bytes], width: int, seed: int = SEED) -> int:
    """SimHash of shingles of width words: a bit is set if it is set in over half of the shingles' hashes."""
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - width + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at : at + CHUNK + width - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(width)], strict=False)) if len(words) >= width else [b" ".join(words)]
        counts += bit_counts(np.fromiter((digest(s, seed) for s in shingles), np.uint64))
    return majority(counts, n)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(rid, doc_id, fp): fp is the fingerprint as a signed long; rid numbers the rows as monotonically_increasing_id() does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(raw.lower().split(), width) for raw in text_bytes(batch.column(2))], np.uint64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["rid", "doc_id", "fp"])

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "rid long, doc_id long, fp long")


def embed(fp: str) -> str:
    """SQL of the bit counts of the 16 segments of fp, four bits each."""
    one_each = 0x1111111111111111
    return "(" + " + ".join(f"(shiftrightunsigned({fp}, {i}) & {one_each}L)" for i in range(4)) + ")"


def grid_points(point: str, low: int = 0, high: int = SEGMENTS) -> Column:
    """The grid points within Manhattan distance 1 of point in segments low to high - 1: itself, and one more or less in each of them."""
    near = f"""concat(array({point}),
        transform(filter(sequence({low}, {high - 1}), i -> (shiftrightunsigned({point}, 4 * i) & 15L) < 4), i -> {point} + shiftleft(1L, 4 * i)),
        transform(filter(sequence({low}, {high - 1}), i -> (shiftrightunsigned({point}, 4 * i) & 15L) > 0), i -> {point} - shiftleft(1L, 4 * i)))"""
    return F.expr(near)


def bit_strings(fp: str, low: int = 0, high: int = SEGMENTS) -> Column:
    """The bit strings within Hamming distance 1 of fp in segments low to high - 1."""
    return F.expr(f"concat(array({fp}), transform(sequence({4 * low}, {4 * high - 1}), i -> {fp} ^ shiftleft(1L, i)))")


def parts(bits: int) -> list[tuple[int, int]]:
    """Ranges of segments, of which one at least differs in at most 2 bits if the fingerprints differ in at most bits."""
    n = bits // 3 + 1
    return [(SEGMENTS * k // n, SEGMENTS * (k + 1) // n) for k in range(n)]


def shared_strings(rows: DataFrame, low: int = 0, high: int = SEGMENTS) -> DataFrame:
    """The columns of rows, which has fp, and string: rows share a string exactly if their fps differ in at most 2 bits of segments low to high - 1.

    Rows without any partner on the grid have none.
    """
    fp = "fp" if (low, high) == (0, SEGMENTS) else f"(fp & {(1 << 4 * high) - (1 << 4 * low) - ((1 << 64) if high == SEGMENTS else 0)}L)"
    points = cut(rows.select("*", F.expr(embed(fp)).alias("point")))
    cells = points.select(*rows.columns, F.explode(grid_points("point", low, high)).alias("cell"))
    # a point shared by two fingerprints is verified at once; only where more meet are the bit strings needed
    shared = cells.groupBy("cell").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    shared = cut(shared.filter(f"n > 2 or n = 2 and bit_count({fp.replace('fp', 'a')} ^ {fp.replace('fp', 'b')}) <= 2").select("cell"))
    near = cut(skewed_join(cells, shared, ["cell"]).select(*rows.columns).distinct())
    return near.select("*", F.explode(bit_strings(fp, low, high)).alias("string"))


def links(fps: DataFrame) -> DataFrame:
    """Edges (u, v) whose components are those of all links between distinct fingerprints fp at 2 or fewer differing bits."""
    groups = shared_strings(fps.select("fp")).groupBy("string").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1")  # 65 at most
    edges = groups.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u"))
    return edges.filter("u != v and bit_count(u ^ v) <= 2").select("u", "v")


def simhash_groups(docs: DataFrame, width: int = 3) -> DataFrame:
    """Groups documents by chains of fingerprints that differ in at most 2 bits: rid, doc_id, fp, component_id, kept.

    docs has doc_id and text; other columns are ignored. Words are what is between space and U+0009 to U+000D, with A to Z
    in lower case; shingles of width words are hashed by XXH64, repeats included. A text of fewer words is one shingle;
    one without words, or null, has fingerprint 0, which links like any other. component_id is the smallest doc_id of
    the group (null ones don't count; null if there is no other). The first row with that doc_id is kept of the
    group. A row a document; an empty table gives an empty result.
    """
    rows = cut(fingerprints(docs, width))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    fps = cut(rows.groupBy("fp").agg(first.alias("first")))
    comps = cut(components(links(fps.select("fp"))))
    rooted = cut(fps.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    firsts = cut(rooted.groupBy("root").agg(F.min("first").alias("first")).select("root", F.col("first.doc_id").alias("component_id"), F.col("first.rid").alias("__kept")))
    named = cut(skewed_join(rooted.select("fp", "root"), firsts, ["root"]).select("fp", "component_id", "__kept"))
    return skewed_join(rows, named, ["fp"]).select("rid", "doc_id", "fp", "component_id", (F.col("rid") == F.col("__kept")).alias("kept"))
