"""Near-duplicates by SimHash with a check of the Jaccard similarity of word shingles, for the pipeline.

Operator 5's fingerprints, of the sets of shingles, choose candidates: its range join on the segments' bit counts is made in parts of
the fingerprint, so that all texts whose fingerprints differ in at most BITS bits are candidates, and others that differ in more. At a
similarity of 0.8 up to about 20 bits differ, as in many unrelated texts; so for the rest texts that share a band of MinHash
values are candidates too. All links are verified on the whole sets of shingles.

Texts with equal sets are one node. In buckets of few nodes all pairs whose sizes allow the similarity are verified, so a partner by
chance costs no more than that, and mostly nothing. In larger ones a node is first verified against few others, those of its buckets that meet
most others, which joins the bulk of large groups. Of the nodes whose larger buckets still hold several components, pairs from different ones
are found by a prefix filter, which is exact: with shingles in the order of how many of these nodes have them, rare ones first,
two sets can be similar only if they share one among the first few of both, and one that comes late enough in either rules the
pair out by itself. So altered copies that are too far apart for a link cost no pairs, however large their group is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlink.llm.common import cut, identified, skewed_join, slices, sparing, text_bytes
from spanlink.llm.graph import components
from spanlink.llm.simhash import SEED, bit_counts, majority, parts, shared_strings

#: Differing bits at which fingerprints are candidates in any case: parts of 32 bits, as shorter ones tell too few texts apart.
BITS = 5
#: Bands and MinHash values of each: a pair with similarity 0.8 shares a band with probability 0.9996.
BANDS, ROWS = 20, 5
#: Nodes of a group in which sets are verified.
GROUP = 1000
#: Nodes of a bucket of which all pairs are verified: more than chance brings together at some ten million texts.
FEW = 4
#: Nodes that a node of a larger bucket is verified against first.
PIVOTS = 4
#: Shingles hashed at once.
CHUNK = 1 << 10

_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_TERMS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct XXH64 of the shingles of width words; fewer words are one shingle, none have none."""
    if len(words) < width:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)], strict=False))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64))


def bands(hashes: np.ndarray) -> np.ndarray:
    """A hash of each band's number and MinHash values; none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        mixed = hashes[at : at + CHUNK, None] * _FACTORS + _TERMS
        np.minimum(least, mixed.min(0), out=least)
    return np.array([xxhash.xxh64_intdigest(v.tobytes(), b) for b, v in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def _texts(docs: DataFrame, rid: str) -> DataFrame:
    return docs.select(F.col(rid).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _set(raw: bytes, width: int) -> np.ndarray:
    return shingle_set(raw.lower().split(), width)


def _signatures(rows: DataFrame, width: int) -> DataFrame:
    """(rid, doc_id, same, n, fp, bands) of texts: n is the size of the set of shingles; equal sets have equal same and fp, its fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            same, n, fps, found = [], [], [], []
            for s in (_set(raw, width) for raw in text_bytes(batch.column(2))):
                fps.append(majority(bit_counts(s), len(s)))
                same.append(xxhash.xxh128_digest(s.tobytes()))
                n.append(len(s))
                found.append(bands(s))
            columns = [pa.array(same, pa.binary()), pa.array(n, pa.int32()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(found, pa.list_(pa.int64()))]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], ["rid", "doc_id", "same", "n", "fp", "bands"])

    return rows.mapInArrow(run, f"rid {rows.schema['rid'].dataType.simpleString()}, doc_id long, same binary, n int, fp long, bands array<bigint>")


def _sets(rows: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [_set(raw, width).view(np.int64) for raw in text_bytes(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return rows.mapInArrow(run, "node long, shingles array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of pairs (u, v) whose sets (node, shingles) have at least the given similarity.

    Nodes are dealt over groups of about GROUP, and pairs meet in their pair of groups, to which a set is sent once however many pairs
    there need it.
    """
    pairs = cut(pairs.distinct())
    n = pairs.select(F.explode(F.array("u", "v")).alias("node")).agg(F.approx_count_distinct("node")).first()[0]
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(max(1, -(-n // GROUP))))
    placed = pairs.select(group("u").alias("i"), group("v").alias("j"), "u", "v")
    asked = placed.select(F.struct("i", "j").alias("to"), F.explode(F.array("u", "v")).alias("node"))
    asked = asked.groupBy("node").agg(F.collect_set("to").alias("to"))  # a row a node, so sets are shuffled once; 2 pairs for each group at most
    sent = sets.join(asked, "node").select(F.explode("to").alias("to"), "node", "shingles").select("to.*", "node", "shingles")
    none = F.lit(None)
    both = sent.select("i", "j", "node", "shingles", none.cast("long").alias("v")).unionByName(placed.select("i", "j", F.col("u").alias("node"), none.cast("array<bigint>").alias("shingles"), "v"))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        held = pdf[pdf["v"].isna()]
        of = dict(zip(held["node"], held["shingles"], strict=True))
        asked = pdf[~pdf["v"].isna()]
        out = []
        for u, v in zip(asked["node"].astype("int64"), asked["v"].astype("int64"), strict=True):
            x, y = of[u], of[v]
            shared = len(np.intersect1d(x, y, assume_unique=True))
            if shared >= least * (len(x) + len(y) - shared):
                out.append((u, v))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    both = both.withColumn("v", F.col("v").cast("string"))  # pandas would make a float of a number that may be null
    return both.groupBy("i", "j").applyInPandas(verify, "u long, v long")


def _needed(a: str, b: str, least: float) -> Column:
    """Shingles that sets of sizes a and b must share; a little less, as the product may be rounded up."""
    return F.ceil(F.lit(least / (1 + least)) * (F.col(a) + F.col(b)) - F.lit(1e-6))


def prefix_pairs(nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """All pairs (u, v) of nodes (node, n, root) with different roots that may have the given similarity.

    Shingles that one node alone has come first in its order and can't be shared, so only their number counts.
    """
    tokens = cut(sets.join(nodes.select("node"), "node", "left_semi").select("node", F.explode("shingles").alias("token")))
    shared = cut(tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"))
    # the order is by df, then the token; only as many shared ones are kept as may lie in the prefix
    known = skewed_join(tokens, shared, ["token"], spread=F.col("node"))
    ordered = known.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("tokens"))  # a set's size at most
    x = nodes.join(ordered, "node")
    own = F.col("n") - F.size("tokens")
    prefix = F.col("n") - F.ceil(F.lit(least) * F.col("n") - F.lit(1e-6)) + 1
    x = x.select("node", "n", "root", own.alias("own"), F.slice("tokens", F.lit(1), F.greatest(F.lit(0), prefix - own).cast("int")).alias("tokens"))
    x = cut(x.select("node", "n", "root", "own", F.posexplode("tokens").alias("at", "t")).select("node", "n", "root", (F.col("own") + F.col("at")).alias("at"), F.col("t.token").alias("token")))
    several = x.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("token")
    x = cut(skewed_join(x, several, ["token"], spread=F.col("node")))
    # the smaller set's own prefix is shorter still, as the other isn't smaller
    short = F.col("n") - F.ceil(F.lit(2 * least / (1 + least)) * F.col("n") - F.lit(1e-6)) + 1
    y = x.filter(F.col("at") < short).select(*[F.col(c).alias(f"__{c}") for c in ("node", "n", "root", "at")], "token")
    larger = (F.col("n") > F.col("__n")) | ((F.col("n") == F.col("__n")) & (F.col("node") > F.col("__node")))
    most = F.least(F.col("n") - F.col("at"), F.col("__n") - F.col("__at"))  # if this is the first one that both have
    fits = (F.col("x.token") == F.col("y.token")) & (F.col("root") != F.col("__root")) & larger & (F.col("__n") >= F.lit(least) * F.col("n") - F.lit(1e-6)) & (most >= _needed("n", "__n", least))
    return x.alias("x").join(y.alias("y"), fits).select(F.greatest("node", "__node").alias("u"), F.least("node", "__node").alias("v")).distinct()


def links(nodes: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """Edges (u, v) whose components are those of all candidates among nodes (node, rid, n, fp, bands) with at least the given similarity.

    Only sets of nodes that are in a larger bucket or in a pair to be verified are held; they are made again from texts (rid, text).
    """
    members = nodes.select("node", "n", F.explode("bands").alias("band"))
    for low, high in parts(BITS):
        close = shared_strings(nodes.filter("n > 0").select("node", "n", "fp"), low, high)
        members = members.unionByName(close.select("node", "n", F.xxhash64(F.lit(low), "string").alias("band")))
    sizes = members.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    members = cut(skewed_join(members, sizes, ["band"]))
    # sets whose sizes differ too much can't be that similar
    near = F.least("n", "m") >= least * F.greatest("n", "m")
    few = members.filter(F.col("size") <= FEW).groupBy("band").agg(F.collect_list(F.struct("node", "n")).alias("x")).select("x", F.explode("x").alias("y"))
    few = few.select(F.explode("x").alias("x"), "y").select(F.col("x.node").alias("u"), F.col("y.node").alias("v"), F.col("x.n").alias("n"), F.col("y.n").alias("m"))
    few = cut(few.filter("u > v").filter(near).select("u", "v").distinct())
    members = members.filter(F.col("size") > FEW)
    # the node that meets most others is likely the text that a group's copies were made from
    central = members.groupBy("node").agg(F.sum("size").alias("central"))
    members = cut(members.join(central, "node").select("node", "n", "band", "central"))
    pivots = members.groupBy("band").agg(F.max(F.struct("central", (-F.col("node")).alias("v"), "n")).alias("pivot"))
    members = cut(skewed_join(members, pivots, ["band"], spread=F.col("node")))
    tried = members.select("node").unionByName(few.select(F.explode(F.array("u", "v")).alias("node"))).distinct()
    wanted = nodes.select("node", "rid").join(tried, "node", "left_semi")
    sets = cut(_sets(texts.join(cut(wanted), "rid").select("node", "text"), width))
    stars = members.select(F.col("node").alias("u"), "n", F.col("pivot.n").alias("m"), F.struct("pivot.central", "pivot.v").alias("to")).filter("u != -to.v").filter(near)
    best = stars.groupBy("u").agg(F.slice(F.reverse(F.array_sort(F.collect_set("to"))), 1, PIVOTS).alias("to"))  # a band each at most
    best = best.select("u", F.explode("to").alias("to")).select(F.greatest("u", -F.col("to.v")).alias("u"), F.least("u", -F.col("to.v")).alias("v"))
    edges = cut(_verified(best.unionByName(few), sets, least))
    rooted = members.select("band", "node", "n").join(cut(components(edges)), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = cut(rooted)
    mixed = rooted.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("band")
    left = cut(skewed_join(rooted, mixed, ["band"], spread=F.col("node")).select("node", "n", "root").distinct())
    return edges.unionByName(_verified(prefix_pairs(left, sets, least), sets, least))


def near_groups(docs: DataFrame, width: int = 5, least: float = 0.8, rid: str | None = None) -> DataFrame:
    """Groups documents by chains of texts whose sets of shingles have a Jaccard similarity of at least least: rid, doc_id, component_id, kept.

    docs has doc_id and text; other columns are ignored. Words and shingles are those of simhash_groups(), repeats left out. Texts without
    words, or null, are equal to each other. rid is the column of that name, which must tell rows apart in every read, or what identified()
    gives; texts are read twice, so that only those with a candidate are held. component_id and the row that is kept are found as
    simhash_groups() does. A row a document; an empty table gives an empty result.
    """
    if rid is None:
        docs, rid = identified(docs)
    texts = _texts(docs, rid)
    with sparing(docs.sparkSession):
        rows = cut(_signatures(texts, width))
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
        nodes = rows.groupBy("same").agg(first.alias("first"), F.min(F.struct("rid", "n", "fp", "bands")).alias("s"))
        nodes = cut(nodes.select(F.monotonically_increasing_id().alias("node"), "same", "first", F.col("s.rid").alias("rid"), "s.n", "s.fp", "s.bands"))
        rows = rows.select("rid", "doc_id", "same")
        comps = cut(components(links(nodes.select("node", "rid", "n", "fp", "bands"), texts.select("rid", "text"), width, least)))
        rooted = cut(nodes.select("node", "same", "first").join(comps, "node", "left").select("same", "first", F.coalesce("root", "node").alias("root")))
        firsts = cut(rooted.groupBy("root").agg(F.min("first").alias("first")).select("root", F.col("first.doc_id").alias("component_id"), F.col("first.rid").alias("__kept")))
        named = cut(skewed_join(rooted.select("same", "root"), firsts, ["root"]).select("same", "component_id", "__kept"))
    return skewed_join(rows, named, ["same"]).select("rid", "doc_id", "component_id", (F.col("rid") == F.col("__kept")).alias("kept"))
