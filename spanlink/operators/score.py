"""Scoring predictions against gold: counts of exact matches, micro and macro averages, error attribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlink.functions.metrics import scores


def category(label: Column, own: tuple[str, ...] = ("location", "date", "organization")) -> Column:
    return F.when(F.lower(label).isin(*own), F.lower(label)).otherwise(F.lit("event_or_risk"))


def matches(pred: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """keys with in_pred and in_gold: the distinct rows of both sides, null-safe by a union instead of an outer join."""
    both = pred.select(*keys, F.lit(True).alias("p"), F.lit(False).alias("g")).unionByName(gold.select(*keys, F.lit(False).alias("p"), F.lit(True).alias("g")))
    return both.groupBy(*keys).agg(F.bool_or("p").alias("in_pred"), F.bool_or("g").alias("in_gold"))


def counts(matched: DataFrame, by: list[str]) -> DataFrame:
    """tp, fp and fn of matches() by some of its keys."""
    return matched.groupBy(*by).agg(F.count_if(F.expr("in_pred and in_gold")).alias("tp"), F.count_if(F.expr("in_pred and not in_gold")).alias("fp"), F.count_if(F.expr("not in_pred and in_gold")).alias("fn"))


def per_document(pred: DataFrame, gold: DataFrame, keys: list[str], documents: DataFrame, failed: DataFrame | None = None, on_error: str = "score_empty") -> DataFrame:
    """tp, fp and fn of every document (doc_id), 0 without predictions and gold.

    failed lists documents whose extraction failed: they count as without predictions ("score_empty") or not at all ("skip").
    """
    if failed is not None:
        pred = pred.join(failed.select("doc_id"), "doc_id", "left_anti")
        if on_error == "skip":
            gold, documents = (x.join(failed.select("doc_id"), "doc_id", "left_anti") for x in (gold, documents))
        elif on_error != "score_empty":
            raise ValueError(f"on_error is score_empty or skip, not {on_error}")
    own = counts(matches(pred, gold, keys), ["doc_id"])
    return documents.select("doc_id").distinct().join(own, "doc_id", "left").fillna(0, ["tp", "fp", "fn"])


def micro(per_doc: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Scores of the summed counts."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")]
    return per_doc.groupBy(*(by or [])).agg(*sums).withColumns(scores())


def macro(per_doc: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The mean of the documents' F1; a document without predictions and gold counts as 0."""
    return per_doc.withColumns(scores()).groupBy(*(by or [])).agg(F.avg("f1").alias("macro_f1"), F.count("*").alias("documents"))


def missed_and_wrong(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """Pairs (doc_id, event, location) in only one of pred and gold, with what the other side has for the event (the first by name)."""
    keys = ["doc_id", "event", "location"]
    m = matches(pred, gold, keys)
    other = m.groupBy("doc_id", "event").agg(F.min(F.when(F.col("in_pred"), F.col("location"))).alias("linked_to"), F.min(F.when(F.col("in_gold"), F.col("location"))).alias("expected"))
    x = m.filter("in_pred != in_gold").join(other, ["doc_id", "event"])
    return x.select(*keys, F.when(F.col("in_gold"), "missed").otherwise("wrong").alias("error"), F.when(F.col("in_gold"), F.col("linked_to")).otherwise(F.col("expected")).alias("instead"))


def error_listing(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """missed_and_wrong() in the order of a report: document, missed before wrong, event, location."""
    return missed_and_wrong(pred, gold).orderBy("doc_id", "error", "event", "location")
