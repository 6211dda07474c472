"""Scores from counts of true positives, false positives and false negatives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def f_beta(p: Column, r: Column, beta: float) -> Column:
    b2 = beta * beta
    return ratio((1 + b2) * p * r, b2 * p + r)


def scores(tp: str = "tp", fp: str = "fp", fn: str = "fn") -> dict[str, Column]:
    """precision, recall, f1, f05, f2 and jaccard; each is 0 where its denominator is."""
    t, p, n = F.col(tp).cast("double"), F.col(fp).cast("double"), F.col(fn).cast("double")
    precision, recall = ratio(t, t + p), ratio(t, t + n)
    return {
        "precision": precision,
        "recall": recall,
        "f1": f_beta(precision, recall, 1),
        "f05": f_beta(precision, recall, 0.5),
        "f2": f_beta(precision, recall, 2),
        "jaccard": ratio(t, t + p + n),
    }


def efficiency(f1: Column, seconds: Column) -> Column:
    """Score for its time: f1 over log2(seconds + 2), rounded half to even at 4 places; 0 without a score."""
    return F.when(f1 > 0, F.bround(f1 / F.log2(seconds + 2), 4)).otherwise(F.lit(0.0))


def per_minute(seconds: Column) -> Column:
    return F.when(seconds > 0, 60 / seconds).otherwise(F.lit(float("inf")))
