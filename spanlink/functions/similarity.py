"""Similarity of texts and vectors, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanlink.functions.text import WORD


def tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def token_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of the sets of lower-case words; 0 if both are empty."""
    x, y = tokens(a), tokens(b)
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union).otherwise(F.lit(0.0))


def contains_either(a: Column, b: Column) -> Column:
    """1 if one lower-case text contains the other and neither is empty."""
    x, y = F.lower(a), F.lower(b)
    return F.when((x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x)), F.lit(1.0)).otherwise(F.lit(0.0))


def edit_similarity(a: Column, b: Column) -> Column:
    """1 less the edit distance of the lower-case texts over the longer one's length; 1 if both are empty."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(F.lower(a), F.lower(b)) / longest).otherwise(F.lit(1.0))


def relaxed(a: Column, b: Column) -> Column:
    """The best of word overlap, containment and edit similarity."""
    return F.greatest(token_overlap(a, b), contains_either(a, b), edit_similarity(a, b))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 if a vector is zero."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))
