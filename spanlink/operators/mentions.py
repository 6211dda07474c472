"""Finding mentions: a lexicon backend that needs no model, and the interface for backends that do."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.functions.text import WORD, let, running
from spanlink.operators.segment import sentences

#: Terms of a lexicon that is searched by patterns, at most.
PATTERN_TERMS = 300
WORD_CHAR = r"[\p{L}\p{N}_]"
MENTION = "doc_id long, label string, text string, confidence double, start int, end int, source string"


def lexicon_table(spark: SparkSession, lexicon: dict[str, list[str]]) -> DataFrame:
    """(term, label, n_words) of a lexicon; terms are lower-case words separated by single spaces."""
    rows = [(t.lower(), label, len(t.split(" "))) for label, terms in lexicon.items() for t in terms]
    return spark.createDataFrame(rows, "term string, label string, n_words int")


def lexicon_mentions(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Every occurrence of a lexicon's terms as whole words, in any case, overlapping ones too: doc_id, label, text, start, end.

    A lexicon of up to PATTERN_TERMS terms becomes one pattern for each number of words, so that sentences without any term
    are passed by a search; of a longer one, all runs of words meet its terms in an equality join.
    """
    terms = [(r.term, r.n_words) for r in lexicon.select("term", "n_words").distinct().limit(PATTERN_TERMS + 1).collect()]
    if not terms:
        return docs.sparkSession.createDataFrame([], "doc_id long, label string, text string, start int, end int")
    s = sentences(docs)
    if len(terms) <= PATTERN_TERMS:
        sizes = sorted({n for _, n in terms})
        found = [_occurrences([t for t, k in terms if k == n]) for n in sizes]
        x = s.select("doc_id", F.explode_outer(F.concat(*found) if len(found) > 1 else found[0]).alias("r")).filter("r is not null").select("doc_id", "r.*")
    else:
        x = _runs(s, lexicon.agg(F.max("n_words")).first()[0])
    hits = x.join(lexicon, F.lower("text") == F.col("term"))
    return hits.select("doc_id", "label", "text", "start", (F.col("start") + F.length("text")).alias("end"))


def _occurrences(terms: list[str]):
    """Occurrences in s_text of terms with the same number of words, as an array of struct (text, start).

    A match is a term's first word only, with the others looked ahead at, so that terms may overlap.
    """
    ahead: dict[str, list[str]] = {}
    for t in sorted(terms):
        first, _, rest = t.partition(" ")
        ahead.setdefault(first, []).append(rest)
    alone = "|".join(re.escape(f) + (f"(?= (?:{'|'.join(map(re.escape, rests))})(?!{WORD_CHAR}))" if rests != [""] else "") for f, rests in ahead.items())
    pattern = rf"(?iu)(?<!{WORD_CHAR})(?:{alone})(?!{WORD_CHAR})"
    whole = rf"^(?iu)(?:{'|'.join(map(re.escape, sorted(terms, reverse=True)))})(?!{WORD_CHAR})"
    kind = "array<struct<text:string,start:int>>"
    longest = max(map(len, terms)) + 1
    pieces = F.arrays_zip(F.split("s_text", pattern, -1).alias("gap"), F.regexp_extract_all("s_text", F.lit(pattern), F.lit(0)).alias("word"))

    def placed(x):
        at = running(F.transform(x, lambda p: F.length(p["gap"]) + F.length(p["word"])))
        starts = F.transform(F.arrays_zip(x.alias("p"), at.alias("at")), lambda z: z["at"] + F.length(z["p"]["gap"]))
        return F.transform(starts, lambda i: F.struct(F.regexp_extract(F.substring("s_text", i + 1, F.lit(longest)), whole, 0).alias("text"), (F.col("s_start") + i).alias("start")))

    out = let(F.filter(pieces, lambda x: x["word"].isNotNull()), placed)
    return F.when(F.col("s_text").rlike(pattern), out).otherwise(F.array().cast(kind))


def _runs(s: DataFrame, most: int) -> DataFrame:
    """(doc_id, text, start) of every run of up to most words of sentences that are separated by single spaces."""
    kind = "array<struct<word:string,start:int,glued:boolean>>"
    found = F.regexp_extract_all("s_text", F.lit(WORD), F.lit(0))
    zipped = F.filter(F.arrays_zip(found.alias("word"), F.split("s_text", WORD, -1).alias("gap")), lambda x: x["word"].isNotNull())
    zero = F.struct(F.col("s_start").alias("at"), F.array().cast(kind).alias("out"))

    def step(acc, x):
        at = acc["at"] + F.length(x["gap"])
        word = F.struct(x["word"].alias("word"), at.alias("start"), (x["gap"] == " ").alias("glued"))
        return F.struct((at + F.length(x["word"])).alias("at"), F.concat(acc["out"], F.array(word)).alias("out"))

    s = s.select("doc_id", F.aggregate(zipped, zero, step, lambda acc: acc["out"]).alias("words"))
    runs = []
    for n in range(1, most + 1):
        at = F.transform(F.col("words"), lambda w, i: F.struct(i.alias("i"), w["start"].alias("start")))
        runs.append(F.transform(F.filter(at, _glued(n)) if n > 1 else at, _run(n)))
    return s.select("doc_id", F.explode_outer(F.concat(*runs) if most > 1 else runs[0]).alias("r")).filter("r is not null").select("doc_id", "r.*")


def _glued(n: int):
    """Whether the n - 1 words behind a word follow it after single spaces."""

    def test(p):
        rest = F.slice("words", p["i"] + 2, n - 1)
        return (F.size(rest) == n - 1) & F.forall(rest, lambda w: w["glued"])

    return test


def _run(n: int):
    return lambda p: F.struct(F.array_join(F.transform(F.slice("words", p["i"] + 1, n), lambda w: w["word"]), " ").alias("text"), p["start"].alias("start"))


def model_mentions(docs: DataFrame, load: Callable[[], Callable[[list[str]], Iterable[list[dict]]]], floor: float) -> DataFrame:
    """Mentions that a model finds: load() is called once a worker and gives a function from texts to lists of mentions.

    A mention is a dict of label, text, confidence, start and end. A document on which the model fails has no mentions
    and one row with the label "error" and confidence 0, so a bad document never fails a job; count or drop these.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                try:
                    found = next(iter(model([text or ""])))
                    rows += [(doc_id, m["label"], m["text"], float(m["confidence"]), m["start"], m["end"], "model") for m in found if m["confidence"] >= floor]
                except Exception as e:  # noqa: BLE001
                    rows.append((doc_id, "error", str(e)[:200], 0.0, 0, 0, "model"))
            yield pd.DataFrame(rows, columns=["doc_id", "label", "text", "confidence", "start", "end", "source"])

    return docs.select("doc_id", "text").mapInPandas(run, MENTION)


def resolve_coreferences(docs: DataFrame, load: Callable[[], Callable[[str], list[list[tuple[int, int]]]]]) -> DataFrame:
    """(doc_id, m_start, m_end, a_start, a_end, a_text) from a model of clusters of offsets; a failing document has none.

    The first mention of a cluster is the antecedent of all others; clusters of one mention are dropped.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                try:
                    clusters = model(text or "")
                except Exception:  # noqa: BLE001
                    continue
                rows += [(doc_id, s, e, c[0][0], c[0][1], text[c[0][0] : c[0][1]]) for c in clusters for s, e in c[1:]]
            yield pd.DataFrame(rows, columns=["doc_id", "m_start", "m_end", "a_start", "a_end", "a_text"])

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, m_start int, m_end int, a_start int, a_end int, a_text string")


def coref_pairs(clusters: DataFrame) -> DataFrame:
    """As resolve_coreferences(), from a table of clusters (doc_id, strings, offsets as arrays of [start, end])."""
    c = clusters.filter(F.size("offsets") > 1)
    c = c.select("doc_id", "strings", "offsets", F.posexplode("offsets").alias("i", "o")).filter("i > 0")
    return c.select("doc_id", F.col("o")[0].alias("m_start"), F.col("o")[1].alias("m_end"), F.col("offsets")[0][0].alias("a_start"), F.col("offsets")[0][1].alias("a_end"), F.col("strings")[0].alias("a_text"))
