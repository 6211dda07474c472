"""One-to-one matching of predictions and gold by similarity (strict, relaxed or semantic), within each document."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from spanlink.functions.similarity import cosine, relaxed

#: Modes: what scores a pair, on which column, and from which score on it may match.
MODES: dict[str, tuple[Callable[[Column, Column], Column], str, float]] = {
    "strict": (lambda a, b: (F.lower(a) == F.lower(b)).cast("double"), "text", 1.0),
    "relaxed": (relaxed, "text", 0.5),
    "semantic": (cosine, "embedding", 0.7),
}


def candidates(pred: DataFrame, gold: DataFrame, score: Callable[[Column, Column], Column], column: str, threshold: float, by: list[str]) -> DataFrame:
    """(by, ps, gs, score) of values with equal ``by`` that score at least threshold; ps and gs are the sides' ids with these values."""
    a = pred.groupBy(*by, F.col(column).alias("__a")).agg(F.array_sort(F.collect_set("id")).alias("ps"))
    b = gold.groupBy(*by, F.col(column).alias("__b")).agg(F.array_sort(F.collect_set("id")).alias("gs"))
    return a.join(b, by).select(*by, "ps", "gs", score(F.col("__a"), F.col("__b")).alias("score")).filter(F.col("score") >= threshold)


def _assigned(links: DataFrame, by: list[str]) -> DataFrame:
    """Greedy assignment of (by, ps, gs, score), where an id is in one set of ids only: (by, p, g, score).

    At each score, from the highest on, each free p in ascending order takes the smallest free g it is linked to, which is
    the order of all pairs by score, p and g; the pairs themselves aren't listed.
    """
    fields = {f.name: f.dataType for f in links.schema}
    schema = StructType([*[StructField(c, fields[c]) for c in by], StructField("p", fields["ps"].elementType), StructField("g", fields["gs"].elementType), StructField("score", fields["score"])])

    def level(group: tuple, score: float, found: list, taken: set, heads: dict) -> Iterator[tuple]:
        sets: dict = {}
        for ps, gs in found:
            for p in ps:
                if p not in taken:
                    sets.setdefault(p, []).append(gs)
        for p in sorted(sets):
            free = [(gs[heads.get(gs[0], 0)], gs[0]) for gs in sets[p] if heads.get(gs[0], 0) < len(gs)]
            if free:
                g, name = min(free)
                heads[name] = heads.get(name, 0) + 1
                taken.add(p)
                yield (*group, p, g, score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    yield r[: len(by)], r[-1], r[-3], r[-2]

        for group, ranked in groupby(rows(), key=lambda r: r[0]):
            taken, heads = set(), {}
            for score, found in groupby(ranked, key=lambda r: r[1]):
                out = list(level(group, score, [r[2:] for r in found], taken, heads))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), to_arrow_schema(schema).types, strict=True)], names=schema.names)

    x = links.select(*by, "ps", "gs", "score").repartition(*by).sortWithinPartitions(*by, F.desc("score"))
    return x.mapInArrow(run, schema)


def one_to_one(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Greedy assignment: the best pair of all matches, then the best of those whose both sides are free, and so on, until no pair is left.

    Ties are decided by p, then g.
    """
    return _assigned(pairs.select(*by, F.array("p").alias("ps"), F.array("g").alias("gs"), "score"), by)


def match(pred: DataFrame, gold: DataFrame, mode: str, by: list[str], threshold: float | None = None) -> DataFrame:
    """Matched pairs (by, p, g, score) of pred and gold (by, id, text or embedding)."""
    score, column, least = MODES[mode]
    return _assigned(candidates(pred, gold, score, column, least if threshold is None else threshold, by), by)
