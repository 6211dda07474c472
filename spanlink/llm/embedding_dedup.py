"""Operator 10: near-duplicates among embeddings by spherical k-means cells and blocked cosine products.

Several tables of cells are made; in each, spherical k-means assigns every vector to one cell, and vectors are compared within
cells only. A pair just above the threshold may be parted by a border in one table, but hardly by those of all tables: tables are
added until each of thousands of pairs at the threshold is together in at least SHARED, which makes it rare that one is together in none.
Cells grow in number with the rows, so the vectors of a cell stay a few hundred whatever the table holds, and a
vector is sent once for each table. Where no such plan is good enough, there is one cell for all, and nothing can be missed.

In a cell, pairs of blocks meet as matrix products. Vectors that were already together in the first table's cell form
blocks of their own in the others, which aren't compared again, so a large group of copies is compared once. A pair of
blocks returns counts of links, each pair in its first common cell only, and stars instead of pairs: each connected
part is linked to its smallest member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.llm.common import cut, skewed_join, slices
from spanlink.llm.graph import components

#: Vectors of each length that centroids are fitted on, at most.
SAMPLE = 8192
#: Vectors of a label that a cell is meant for.
PER_CELL = 256
#: Centroids of one k-means; more cells are made by combining several.
MOST_CENTROIDS = 64
#: Pairs of either kind that tables are tried on, the tables in which each must be together, and tables at most.
PAIRS, SHARED, TABLES = 4096, 5, 48
#: Vectors of a block, and rows of a product at a time.
BLOCK, ROWS = 4096, 512


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled by the largest component first, as squares may overflow or vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit(sample: np.ndarray, k: int, threshold: float, seed: int, rounds: int = 8) -> np.ndarray:
    """At most k unit centroids of unit vectors by spherical k-means.

    Centroids within twice the threshold's angle are one, so that no border runs through a tight group of copies.
    """
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        home = (sample @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 1e-9, sums / np.where(norms > 1e-9, norms, 1), centroids)
    apart = min(2 * threshold * threshold - 1 if threshold > 0 else -1.0, 1 - 1e-6)
    kept: list[np.ndarray] = []
    for c in centroids:
        if not kept or (np.array(kept) @ c).max() < apart:
            kept.append(c)
    return np.array(kept)


def assign(vectors: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
    """The cell of each unit vector in each table; a table's cell is its k-means' nearest centroids in one number."""
    out = np.zeros((len(vectors), len(tables)), np.int64)
    for t, parts in enumerate(tables):
        for c in parts:
            out[:, t] = out[:, t] * len(c) + (vectors @ c.T).argmax(1)
    return out


def _pairs_at(sample: np.ndarray, threshold: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at the threshold: sampled vectors and others turned by its angle in random directions, and the weakest links in the sample."""
    x = sample[rng.choice(len(sample), PAIRS)]
    d = rng.normal(size=x.shape)
    d -= (d * x).sum(1, keepdims=True) * x
    norms = np.linalg.norm(d, axis=1, keepdims=True)
    turned = threshold * x + math.sqrt(max(0.0, 1 - threshold * threshold)) * d / np.where(norms > 0, norms, 1)
    few = sample[rng.choice(len(sample), min(2048, len(sample)), replace=False)]
    near = few @ few.T
    a, b = np.nonzero(np.triu(near >= threshold, 1))
    farthest = np.argsort(near[a, b])[:PAIRS]
    return np.concatenate([x, few[a[farthest]]]), np.concatenate([turned, few[b[farthest]]])


def make_tables(sample: np.ndarray, rows: int, threshold: float, per_cell: int = PER_CELL, seed: int = 10) -> list[list[np.ndarray]]:
    """Tables of cells for a label of the given rows: as many as it takes for every pair of _pairs_at() to be together in SHARED of them.

    If TABLES aren't enough, there are fewer cells; one table with one cell, where nothing is missed, if there is no other way.
    """
    rng = np.random.default_rng(seed)
    cells = max(4, math.ceil(rows / per_cell))
    x, y = _pairs_at(sample, threshold, rng)
    while cells > 1:
        depth = math.ceil(math.log(cells) / math.log(MOST_CENTROIDS) - 1e-9)
        k = math.ceil(cells ** (1 / depth) - 1e-9)
        tables, together = [], np.zeros(len(x), np.int64)
        while len(tables) < TABLES:
            few = [sample[rng.choice(len(sample), min(len(sample), 64 * k), replace=False)] for _ in range(depth)]
            tables.append([fit(s, k, threshold, seed + 100 * len(tables) + p) for p, s in enumerate(few)])
            if all(len(c) == 1 for c in tables[-1]):  # all in one cell: nothing can be missed
                return tables[-1:]
            together += (assign(x, tables[-1:]) == assign(y, tables[-1:]))[:, 0]
            if together.min() >= SHARED:
                return tables
        cells //= 4
    return [[sample[:1]]]


def _dim_sample(vectors: DataFrame, dim: int) -> np.ndarray:
    """A bounded sample of the unit vectors of one length, by the hash of their number."""
    rows = vectors.filter(F.col("dim") == dim).orderBy(F.xxhash64("vid"), "vid").select("vec").limit(SAMPLE).toArrow()
    flat = rows.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return unit(flat.astype(np.float64).reshape(-1, dim))


def cells(vectors: DataFrame, threshold: float, per_cell: int = PER_CELL) -> DataFrame:
    """vectors (vid, label, dim, vec, n) with cells: the cell in each table."""
    sizes = vectors.groupBy("dim", "label").agg(F.count("*").alias("n")).groupBy("dim").agg(F.max("n").alias("n")).collect()  # a row a vector length
    tables = {r.dim: make_tables(_dim_sample(vectors, r.dim), r.n, threshold, per_cell) for r in sizes}
    kind = vectors.schema["vec"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            vecs = batch.column(3)
            dims = batch.column(2).to_numpy()
            found = np.empty(len(dims), object)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                flat = vecs.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                own = assign(unit(flat.reshape(-1, dim)), tables[dim])
                for i, row in zip(at, own, strict=True):
                    found[i] = row
            yield pa.record_batch([*batch.columns, pa.array(found.tolist(), pa.list_(pa.int64()))], ["vid", "label", "dim", "vec", "n", "cells"])

    return vectors.select("vid", "label", "dim", "vec", "n").mapInArrow(run, f"vid long, label long, dim int, vec {kind}, n long, cells array<bigint>")


def _stars(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """(node, root): the members of each connected part of links between rows a and columns b, and the smallest of them."""
    nodes: list[int] = []
    roots: list[int] = []
    todo = linked.any(1)
    seen = np.zeros(len(b), bool)
    while todo.any():
        front = np.zeros(len(a), bool)
        front[todo.argmax()] = True
        members: set[int] = set()
        while front.any():
            todo &= ~front
            members.update(a[front].tolist())
            reached = linked[front].any(0) & ~seen
            seen |= reached
            members.update(b[reached].tolist())
            front = linked[:, reached].any(1) & todo
        root = min(members)
        members.discard(root)
        nodes += members
        roots += [root] * len(members)
    return nodes, roots


def _block_pair(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Counts and stars of one pair of blocks, or of one block: node, links (null in a star's row), root (null in a count's row)."""
    one, two = pdf[~pdf["second"]], pdf[pdf["second"]]
    alone = not len(two)
    two = one if alone else two
    table = int(pdf["table"].iloc[0])
    a, b = one["vid"].to_numpy(), two["vid"].to_numpy()
    x = unit(np.stack(one["vec"].to_numpy()).astype(np.float64)) if len(one) else None
    out: dict[str, list] = {"node": [], "links": [], "root": []}
    if len(one):
        y = x if alone else unit(np.stack(two["vec"].to_numpy()).astype(np.float64))
        n_a, n_b = one["n"].to_numpy(), two["n"].to_numpy()
        earlier_a, earlier_b = (np.stack(s["cells"].to_numpy())[:, :table] for s in (one, two))
        linked = np.empty((len(a), len(b)), bool)
        counts_a, counts_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        for at in range(0, len(a), ROWS):
            part = x[at : at + ROWS] @ y.T >= threshold
            if alone:
                own = np.arange(at, min(at + ROWS, len(a)))
                part[own - at, own] = False
            linked[at : at + ROWS] = part
            if table:  # links that an earlier table has counted
                r, c = np.nonzero(part)
                new = np.ones(len(r), bool)
                for t in range(table):
                    new &= earlier_a[at + r, t] != earlier_b[c, t]
                part = np.zeros_like(part)
                part[r[new], c[new]] = True
            counts_a[at : at + ROWS] = part @ n_b
            if not alone:
                counts_b += n_a[at : at + ROWS] @ part
        for ids, counts in ((a, counts_a), (b, counts_b)):
            keep = counts > 0
            out["node"] += ids[keep].tolist()
            out["links"] += counts[keep].tolist()
            out["root"] += [None] * int(keep.sum())
        nodes, roots = _stars(linked, a, b)
        out["node"] += nodes
        out["links"] += [None] * len(nodes)
        out["root"] += roots
    return pd.DataFrame({"node": pd.array(out["node"], "Int64"), "links": pd.array(out["links"], "Int64"), "root": pd.array(out["root"], "Int64")})


def _block_pairs(lived: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, links, root) of all pairs of blocks in all cells of lived (vid, label, dim, vec, n, cells)."""
    key = ["label", "dim", "table", "cell"]
    first = F.when(F.col("table") > 0, F.col("cells")[0]).otherwise(F.lit(0))
    exploded = F.posexplode("cells").alias("table", "cell")
    members = lived.select("label", "dim", F.col("cells"), exploded).select(*key, first.alias("sub"))
    sizes = members.groupBy(*key, "sub").agg(F.count("*").alias("n"))
    # what was together in the first table is a block of its own if it's large; small ones share blocks
    sizes = sizes.withColumn("own", (F.col("table") > 0) & (F.col("n") > block))
    groups = sizes.groupBy(*key, F.when(F.col("own"), F.col("sub")).alias("own_sub")).agg(F.sum("n").alias("n"))
    groups = groups.select(*key, "own_sub", F.ceil(F.col("n") / block).cast("int").alias("blocks"), "n")
    blocks = cut(groups)
    # a cell of one vector, and one whose vectors were all together before, has nothing to compare
    whole = blocks.groupBy(*key).agg(F.sum("n").alias("all"), F.count("*").alias("groups"), F.max(F.col("own_sub").isNotNull()).alias("any_own"))
    whole = cut(whole.filter("all > 1 and not (groups = 1 and any_own)").select(*key))
    blocks = cut(blocks.join(whole, key, "left_semi"))
    each = blocks.select(*key, "own_sub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    named = each.withColumn("name", F.concat_ws(":", F.coalesce(F.col("own_sub").cast("string"), F.lit("")), "j"))
    other = named.select(*key, F.col("own_sub").alias("__own"), F.col("name").alias("__name"))
    pairs = named.join(other, key).filter("name <= __name").filter("own_sub is null or __own is null or own_sub != __own")
    tasks = cut(pairs.select(*key, "name", "__name"))
    # where each block goes: a row a pair of blocks it is in
    goes = tasks.select(*key, F.col("name").alias("block"), "name", "__name", F.lit(False).alias("second"))
    goes = goes.unionByName(tasks.filter("name != __name").select(*key, F.col("__name").alias("block"), "name", "__name", F.lit(True).alias("second")))
    goes = goes.groupBy(*key, "block").agg(F.collect_list(F.struct("name", "__name", "second")).alias("to"))  # a cell's blocks at most
    placed = lived.select("vid", "label", "dim", "vec", "n", "cells", exploded).withColumn("sub", first)
    layout = cut(blocks.groupBy(*key).agg(F.max(F.when(F.col("own_sub").isNull(), F.col("blocks"))).alias("shared"), F.map_from_entries(F.collect_list(F.when(F.col("own_sub").isNotNull(), F.struct("own_sub", "blocks")))).alias("owned")))
    placed = skewed_join(placed, layout, key, spread=F.col("vid"))
    own_blocks = F.col("owned")[F.col("sub")]
    mix = F.xxhash64("vid")
    name = F.when(own_blocks.isNotNull(), F.concat_ws(":", F.col("sub").cast("string"), F.pmod(mix, own_blocks))).otherwise(F.concat_ws(":", F.lit(""), F.pmod(mix, F.col("shared"))))
    placed = skewed_join(placed.select("vid", *key, "vec", "n", "cells", name.alias("block")), goes, [*key, "block"], spread=F.col("vid"))
    sent = placed.select(*key, "vid", "vec", "n", F.slice("cells", 1, F.greatest(F.col("table"), F.lit(1))).alias("cells"), F.explode("to").alias("to")).select(*key, "to.*", "vid", "vec", "n", "cells")
    return sent.groupBy(*key, "name", "__name").applyInPandas(lambda pdf: _block_pair(pdf, threshold), "node long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, block: int = BLOCK, per_cell: int = PER_CELL) -> DataFrame:
    """Links vectors of the same label at a cosine of threshold or more: vec_id, n_links, component_id, kept.

    vectors has vec_id, embedding and label; other columns are ignored. The cosine is taken in double precision. A vector
    links with nothing if its label is null, if it is null, empty or zero, or if a component is null or not finite;
    vectors of different lengths aren't linked. A link at the threshold is missed if it's together in no table, at most one in 100,000 as measured
    (README); nearer ones are missed less.
    component_id is the smallest vec_id that can be reached, itself included; kept is
    vec_id = component_id. Equal vectors are compared once and counted as often as they occur, and so are repeated rows; a null vec_id
    counts among links but never is a component_id unless there is no other. An empty table gives an empty result.
    """
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = "array<float>" if element == "float" else "array<double>"  # products are in double precision either way
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast(kind).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = cut(rows.withColumn("good", good))
    valid = rows.filter("good")
    distinct = valid.groupBy("label", "vec").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    distinct = cut(distinct.select(F.monotonically_increasing_id().alias("vid"), "label", F.size("vec").alias("dim"), "vec", "n", "first"))

    pairs = cut(_block_pairs(cut(cells(distinct, threshold, per_cell)), threshold, block))
    counts = pairs.filter("links is not null").groupBy(F.col("node").alias("vid")).agg(F.sum("links").alias("n_links"))
    comps = cut(components(pairs.filter("root is not null").select(F.col("node").alias("u"), F.col("root").alias("v"))))
    x = distinct.select("vid", "label", "vec", "n", "first").join(comps.withColumnRenamed("node", "vid"), "vid", "left").join(counts, "vid", "left")
    x = cut(x.select("vid", "label", "vec", "first", F.coalesce("root", "vid").alias("root"), (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    firsts = cut(x.groupBy("root").agg(F.min("first").alias("component_id")))
    named = cut(skewed_join(x, firsts, ["root"], spread=F.col("vid")).select("label", "vec", "n_links", "component_id"))
    found = skewed_join(valid.select("vec_id", "label", "vec"), named, ["label", "vec"], spread=F.xxhash64("vec_id")).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("vec_id").isNull() & F.col("component_id").isNull()).alias("kept"))
