"""Regular-expression spans with code point offsets, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points kept in front of and behind a match as its context.
BEFORE, AFTER = 48, 8

_FOUND = "array<struct<kind:int,gap:int,text:string,before:string,after:string>>"


def found(text: Column, kind: int, pattern: str) -> Column:
    """The leftmost non-overlapping matches of pattern in order, with the length of the text since the match before.

    What lies between matches comes from split() and the matches from regexp_extract_all(); they alternate, as no
    pattern here matches an empty string. Texts without a match are passed by a single search.
    """
    between = F.transform(F.split(text, pattern, -1), lambda p: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(BEFORE)).alias("before"), F.left(p, F.lit(AFTER)).alias("after")))
    zipped = F.arrays_zip(between.alias("p"), F.slice(between, F.lit(2), F.lit(2147483647)).alias("q"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    whole = F.filter(zipped, lambda x: x["m"].isNotNull())
    out = F.transform(whole, lambda x: F.struct(F.lit(kind).alias("kind"), x["p"]["gap"].alias("gap"), x["m"].alias("text"), x["p"]["before"].alias("before"), x["q"]["after"].alias("after")))
    return F.when(text.rlike(pattern), out).otherwise(F.array().cast(_FOUND))


def scan(docs: DataFrame, patterns: list[str]) -> DataFrame:
    """A row a match: rid, doc_id, kind (the pattern's number), start, end, text, before, after; documents without any have one row of nulls.

    docs has doc_id and text (null: empty). rid numbers the rows of docs as monotonically_increasing_id() does; all
    matches of a row are in one partition of the result.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__t"))
    every = F.concat(*[found(F.col("__t"), k, p) for k, p in enumerate(patterns)])
    rows = rows.select("rid", "doc_id", F.posexplode_outer(every).alias("__pos", "m")).select("rid", "doc_id", "__pos", "m.*")
    rows = rows.repartition("rid")
    upto = Window.partitionBy("rid", "kind").orderBy("__pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("text")
    rows = rows.withColumn("end", F.sum(F.col("gap") + size).over(upto).cast("int"))
    return rows.select("rid", "doc_id", "kind", (F.col("end") - size).alias("start"), "end", "text", "before", "after")


def joined(spans: Column, names: list[str], order: list[str]) -> Column:
    """kind:start:end of an array of structs (kind, start, end), comma-joined in the order of the fields named."""
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(*[s[o].alias(o) for o in order])))
    name = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(keyed, lambda s: F.concat(F.element_at(name, s["kind"] + 1), F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")
