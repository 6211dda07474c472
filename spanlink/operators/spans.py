"""Span algebra: thresholds, duplicates, overlaps, merging. Mentions have doc_id, label, text, confidence, start, end, source and ord.

ord is a mention's place in its document's input order; ties that the order decides are decided by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.config import Config

_SPAN = "struct<start:int,generic:boolean,ord:int,label:string,text:string,confidence:double,end:int,source:string>"


def least_confidence(label: Column, config: Config) -> Column:
    out = F.lit(config.floor)
    for name, value in config.thresholds.items():
        out = F.when(label == name, F.lit(value)).otherwise(out)
    return out


def above_threshold(mentions: DataFrame, config: Config, keep_gazetteer: bool = True) -> DataFrame:
    """Mentions as confident as their label asks for; those of the gazetteer are exempt."""
    ok = F.col("confidence") >= least_confidence(F.col("label"), config)
    return mentions.filter((F.col("source") == "gazetteer") | ok if keep_gazetteer else ok)


def event_like(mentions: DataFrame, config: Config) -> DataFrame:
    return mentions.filter(F.col("label").isin(*config.event_labels))


def _first(df: DataFrame, by: list[Column], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def exact_dedup(mentions: DataFrame) -> DataFrame:
    """The first mention of each text, in any case, and label in a document."""
    return _first(mentions, [F.col("doc_id"), F.lower("text"), F.col("label")], [F.col("ord")])


def merge_chunks(mentions: DataFrame) -> DataFrame:
    """Mentions of chunks as mentions of documents: offsets moved by c_start, the most confident one of each label and text kept.

    At equal confidence the first chunk's is kept, then the first in the chunk. mentions also have chunk_idx and c_start.
    """
    moved = mentions.withColumns({"start": F.col("start") + F.col("c_start"), "end": F.col("end") + F.col("c_start")})
    best = _first(moved, [F.col("doc_id"), F.col("label"), F.lower("text")], [F.desc("confidence"), F.col("chunk_idx"), F.col("ord")])
    return best.drop("c_start")


def _folded(spans: Column) -> Column:
    """Greedy selection of spans sorted by start, specific labels before "event": a span that overlaps an accepted one is dropped, but
    gives its label, confidence and source to an accepted "event".

    Accepted spans are disjoint and sorted, so only the last one can overlap the next span.
    """

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        overlaps = (F.size(acc) > 0) & (F.greatest(s["start"], last["start"]) < F.least(s["end"], last["end"]))
        upgrade = (s["label"] != "event") & (last["label"] == "event")
        named = F.struct(last["start"].alias("start"), last["generic"].alias("generic"), last["ord"].alias("ord"), s["label"].alias("label"), last["text"].alias("text"), s["confidence"].alias("confidence"), last["end"].alias("end"), s["source"].alias("source"))
        upgraded = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(named))
        return F.when(overlaps & upgrade, upgraded).when(overlaps, acc).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(spans, F.array().cast(f"array<{_SPAN}>"), step)


def greedy_dedup(mentions: DataFrame, config: Config) -> DataFrame:
    """Mentions above their thresholds without overlaps, numbered anew from 0 in the order of start."""
    m = above_threshold(mentions, config)
    span = F.struct("start", (F.col("label") == "event").alias("generic"), F.col("ord").cast("int").alias("ord"), "label", "text", "confidence", "end", "source").cast(_SPAN)
    # a span that starts where all before it have ended opens a new chain: no choice reaches over its border
    order = Window.partitionBy("doc_id").orderBy("__s")
    m = m.select("doc_id", span.alias("__s"))
    ended = F.max("__s.end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    m = m.withColumn("__opens", F.coalesce(F.col("__s.start") >= ended, F.lit(True)).cast("int"))
    m = m.withColumn("__chain", F.sum("__opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    grouped = m.groupBy("doc_id", "__chain").agg(F.array_sort(F.collect_list("__s")).alias("spans"))
    out = grouped.select("doc_id", F.explode(_folded(F.col("spans"))).alias("s"))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("s.start", "s.generic", "s.ord")) - 1
    return out.select("doc_id", number.cast("int").alias("ord"), "s.label", "s.text", F.bround("s.confidence", 4).alias("confidence"), "s.start", "s.end", "s.source")


def merge_gazetteer(entities: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Entities without overlaps, and gazetteer mentions added one by one behind them: one that overlaps is dropped, but gives its label
    and confidence 1 to the "event" that it overlaps first; else it's appended. Numbered anew in the order of start.
    """
    kind = "struct<start:int,ord:int,label:string,text:string,confidence:double,end:int,source:string,late:int>"

    def spans(df: DataFrame, late: int) -> DataFrame:
        return df.select("doc_id", F.struct("start", F.col("ord").cast("int").alias("ord"), "label", "text", "confidence", "end", "source", F.lit(late).alias("late")).cast(kind).alias("s"))

    both = spans(entities, 0).unionByName(spans(gazetteer, 1))
    key = lambda x: F.struct(x["s"]["late"].alias("a"), F.when(x["s"]["late"] == 0, x["s"]["start"]).otherwise(x["s"]["ord"]).alias("b"), x["s"]["ord"].alias("c"), x["s"].alias("s"))
    grouped = both.groupBy("doc_id").agg(F.collect_list(F.struct("s")).alias("x"))
    ordered = F.transform(F.array_sort(F.transform("x", key)), lambda k: k["s"])

    def step(acc: Column, s: Column) -> Column:
        hit = F.transform(acc, lambda a: (F.greatest(a["start"], s["start"]) < F.least(a["end"], s["end"])))
        at = F.array_position(hit, F.lit(True)).cast("int")
        named = F.transform(
            acc,
            lambda a, i: F.when(
                (i + 1 == at) & (a["label"] == "event"),
                F.struct(a["start"].alias("start"), a["ord"].alias("ord"), s["label"].alias("label"), a["text"].alias("text"), F.lit(1.0).alias("confidence"), a["end"].alias("end"), s["source"].alias("source"), a["late"].alias("late")),
            ).otherwise(a),
        )
        return F.when((s["late"] == 0) | (at == 0), F.concat(acc, F.array(s))).otherwise(named)

    folded = F.aggregate(ordered, F.array().cast(f"array<{kind}>"), step)
    out = grouped.select("doc_id", F.posexplode(F.array_sort(folded)).alias("ord", "s"))
    return out.select("doc_id", "ord", "s.label", "s.text", "s.confidence", "s.start", "s.end", "s.source")
