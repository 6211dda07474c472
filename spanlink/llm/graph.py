"""Connected components of links, without collecting them and without a task that holds a whole component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.llm.common import cut, skewed_join


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of each node of edges (u, v): root is the smallest node that can be reached.

    Large-star and small-star steps alternate until the edges are stars around the roots; each step links
    a node's neighbours to the smallest of them, so edges never multiply. The nodes' minima are found by partial aggregation, and
    the neighbours of a hub meet them in several parts. Edges from a node to itself, repeated ones and nulls are ignored.
    """
    e = edges.filter("u is not null and v is not null and u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = cut(e.distinct())
    before = _state(e)
    for _ in range(rounds):
        if not before[0]:
            break
        # large star: a node's larger neighbours are linked to the smallest of the node and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.filter("v > u")
        e = skewed_join(larger, least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        e = cut(e)
        # small star: a node and its smaller neighbours are linked to the smallest of them
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        moved = skewed_join(e, least, ["u"]).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
