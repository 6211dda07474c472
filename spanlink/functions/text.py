"""Column functions on text. Offsets are code points, ends are exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanlink.config import ENGLISH_WORDS

#: Ends of sentences: white space after a closing mark, or an empty line.
SENTENCE_END = r"(?U)(?<=[.!?])\s+|\n\n+"
WORD = r"[\p{L}\p{N}_]+"


def stripped(text: Column) -> Column:
    """text without any Unicode white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def first_text(*columns: Column) -> Column:
    """The first column that is neither null nor empty, or an empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def let(value: Column, f) -> Column:
    """f(value), with value computed once however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def running(sizes: Column, part: int = 64) -> Column:
    """The sum of the sizes before each one, for an array that isn't empty.

    Arrays grow by copies, so sums are made within parts and over parts: twice the elements take about twice the time.
    """

    def within(xs: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(xs, zero, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def merged(x: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / part).cast("int")), lambda i: F.slice(x, i * part + 1, part))

        def based(p: Column) -> Column:
            bases = within(F.transform(p, lambda q: F.aggregate(q, F.lit(0), lambda a, v: a + v)))
            return F.flatten(F.transform(F.arrays_zip(p.alias("p"), bases.alias("b")), lambda z: F.transform(within(z["p"]), lambda at: at + z["b"])))

        return let(parts, based)

    return let(sizes, merged)


def spans(text: Column, pattern: str) -> Column:
    """What lies between matches of pattern, as an array of struct (text, start, end); offsets run along the array."""
    gaps = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("text"), gaps.alias("gap"))

    def placed(x: Column) -> Column:
        starts = running(F.transform(x, lambda p: F.length(p["text"]) + F.coalesce(p["gap"], F.lit(0))))
        return F.transform(F.arrays_zip(x.alias("p"), starts.alias("at")), lambda z: F.struct(z["p"]["text"].alias("text"), z["at"].alias("start"), (z["at"] + F.length(z["p"]["text"])).alias("end")))

    return let(pieces, placed)


def sentences(text: Column) -> Column:
    """Sentences of text as an array of struct (text, start, end). A last one is dropped if it's empty, a first one isn't."""
    t = F.coalesce(text, F.lit(""))
    return F.filter(spans(t, SENTENCE_END), lambda s: ~((s["text"] == "") & (s["end"] == F.length(t))))


def contiguous(text: Column) -> Column:
    """Segments of text without gaps: each sentence with the white space behind it; blank ones are dropped. Array of struct (text, start, end)."""
    t = F.coalesce(text, F.lit(""))
    starts = F.array_distinct(F.concat(F.array(F.lit(0)), F.transform(sentences(t), lambda s: s["start"])))
    pairs = let(starts, lambda x: F.arrays_zip(x.alias("start"), F.concat(F.slice(x, F.lit(2), F.size(x)), F.array(F.length(t))).alias("end")))
    out = F.transform(pairs, lambda p: F.struct(F.substring(t, p["start"] + 1, p["end"] - p["start"]).alias("text"), p["start"].alias("start"), p["end"].alias("end")))
    return F.filter(out, lambda s: s["text"].rlike(r"\S"))


def chunks(text: Column, most: int = 1500) -> Column:
    """Contiguous segments joined while the length stays up to most: array of struct (text, start, end). A longer segment is a chunk alone."""
    t = F.coalesce(text, F.lit(""))
    kind = "array<struct<start:int,end:int>>"

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        own = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        longer = F.struct(last["start"].alias("start"), s["end"].alias("end"))
        fits = (F.size(acc) > 0) & (s["end"] - F.try_element_at(acc, F.lit(-1))["start"] <= most)
        return F.when(F.size(acc) == 0, F.array(own)).when(fits, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(own)))

    bounds = F.aggregate(contiguous(t), F.array().cast(kind), step)
    return F.transform(bounds, lambda b: F.struct(F.substring(t, b["start"] + 1, b["end"] - b["start"]).alias("text"), b["start"].alias("start"), b["end"].alias("end")))


def english_hits(text: Column) -> Column:
    """How often words of the English list occur in text, repeats included."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.size(F.filter(words, lambda w: w.isin(ENGLISH_WORDS)))


def mention_offset(text: Column, mention: Column) -> Column:
    """Where mention first occurs in text, in any case; null if it doesn't."""
    at = F.instr(F.lower(text), F.lower(mention))
    return F.when(at > 0, at - 1)


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return F.greatest(a_start, b_start) < F.least(a_end, b_end)
