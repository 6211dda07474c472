"""Documents to segments: sentences, contiguous segments, chunks, overlapping chunks. One row a segment."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from spanlink.functions import text as T


def _rows(docs: DataFrame, segments, prefix: str, index: str) -> DataFrame:
    # an inner explode would compute the segments once more, to filter documents without any
    x = docs.select("doc_id", F.posexplode_outer(segments).alias(index, "s")).filter("s is not null")
    return x.select("doc_id", index, F.col("s.start").alias(f"{prefix}_start"), F.col("s.end").alias(f"{prefix}_end"), F.col("s.text").alias(f"{prefix}_text"))


def sentences(docs: DataFrame) -> DataFrame:
    """(doc_id, sent_idx, s_start, s_end, s_text) of docs (doc_id, text); null and empty texts have none."""
    return _rows(docs, T.sentences(F.col("text")), "s", "sent_idx")


def contiguous(docs: DataFrame) -> DataFrame:
    """As sentences(), but without gaps between segments, and blank ones left out of the numbering."""
    return _rows(docs, T.contiguous(F.col("text")), "s", "sent_idx")


def chunks(docs: DataFrame, most: int = 1500) -> DataFrame:
    """(doc_id, chunk_idx, c_start, c_end, c_text): contiguous segments joined up to most code points."""
    return _rows(docs, T.chunks(F.col("text"), most), "c", "chunk_idx")


def overlap_bounds(text: str, most: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Bounds of overlapping chunks: most code points each, cut behind the last ". " of the second half if there is one."""
    start = 0
    while start < len(text):
        end = start + most
        if end < len(text):
            stop = text.rfind(". ", start, end)
            if stop > start + most // 2:
                end = stop + 2
        yield start, min(end, len(text))
        if end >= len(text):
            return
        start = end - overlap


@udtf(returnType="chunk_idx int, c_start int, c_end int, c_text string")
class _OverlapChunks:
    def eval(self, text: str, most: int, overlap: int):
        for i, (a, b) in enumerate(overlap_bounds(text or "", most, overlap)):
            yield i, a, b, text[a:b]


def overlap_chunks(docs: DataFrame, most: int = 1500, overlap: int = 200) -> DataFrame:
    """(doc_id, chunk_idx, c_start, c_end, c_text): each chunk begins overlap code points before the end of the one before.

    Where a chunk ends depends on where the last one ended, which no built-in function expresses: a table function
    gets the texts as they are scanned, without a shuffle.
    """
    if most <= 2 * overlap:
        raise ValueError("chunks must be more than twice as long as their overlap")
    call = _OverlapChunks(F.col("text").outer(), F.lit(most), F.lit(overlap))
    return docs.select("doc_id", "text").lateralJoin(call).select("doc_id", "chunk_idx", "c_start", "c_end", "c_text")


def words(segments: DataFrame) -> DataFrame:
    """(doc_id, sent_idx, k, word, start, end, gap) of sentences: words, with offsets in the document and what is in front of them."""
    kind = "array<struct<word:string,gap:string,start:int>>"
    found = F.regexp_extract_all("s_text", F.lit(T.WORD), F.lit(0))
    zipped = F.filter(F.arrays_zip(found.alias("word"), F.split("s_text", T.WORD, -1).alias("gap")), lambda x: x["word"].isNotNull())
    zero = F.struct(F.col("s_start").alias("at"), F.array().cast(kind).alias("out"))

    def step(acc, x):
        at = acc["at"] + F.length(x["gap"])
        word = F.struct(x["word"].alias("word"), x["gap"].alias("gap"), at.alias("start"))
        return F.struct((at + F.length(x["word"])).alias("at"), F.concat(acc["out"], F.array(word)).alias("out"))

    out = F.aggregate(zipped, zero, step, lambda acc: acc["out"])
    x = segments.select("doc_id", "sent_idx", F.posexplode(out).alias("k", "w"))
    return x.select("doc_id", "sent_idx", "k", "w.word", "w.start", (F.col("w.start") + F.length("w.word")).alias("end"), "w.gap")
