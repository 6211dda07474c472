"""Choosing documents for a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlink.functions.text import english_hits, first_text, stripped


def spread(docs: DataFrame) -> DataFrame:
    """docs, dealt by doc_id if their files come in fewer splits than there are cores, as a file of one row group does.

    A large table has enough splits and isn't shuffled.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs if docs._jdf.queryExecution().toRdd().getNumPartitions() >= cores else docs.repartition(cores, "doc_id")


def passes(text: Column, shortest: int = 300, longest: int = 3000, hits: int = 3) -> Column:
    """Whether a text has a fitting length without outer white space, and enough frequent English words."""
    return F.length(stripped(text)).between(shortest, longest) & (english_hits(stripped(text)) >= hits)


def corpus_filter(docs: DataFrame, *texts: str, shortest: int = 300, longest: int = 3000, hits: int = 3) -> DataFrame:
    """Documents that pass, with text from the first column of texts that has any; the cheap test comes first."""
    x = docs.withColumn("text", stripped(first_text(*[F.col(t) for t in texts or ("text",)])))
    return x.filter(F.length("text").between(shortest, longest)).filter(english_hits(F.col("text")) >= hits)


def scrambled(key: Column, seed: int) -> Column:
    """A number that looks random, by arithmetic any engine can repeat."""
    return F.pmod(key * F.lit(1103515245) + F.lit(seed * 12345 + 1013904223), F.lit(2147483647))


def seen(docs: DataFrame, cap: int) -> DataFrame:
    """The first cap documents by doc_id: the cap counts the rows that are seen, whether they pass a filter or not."""
    return docs.orderBy("doc_id").limit(cap)


def sample(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """n documents chosen by scrambled doc_id, with name article_000 ... in the order of choice."""
    x = docs.withColumn("__r", scrambled(F.col("doc_id"), seed)).orderBy("__r", "doc_id").limit(n)
    from pyspark.sql import Window

    number = F.row_number().over(Window.orderBy("__r", "doc_id")) - 1  # over n rows
    return x.withColumn("name", F.format_string("article_%03d", number)).drop("__r")


def preview(docs: DataFrame, n: int = 3, width: int = 200) -> DataFrame:
    return docs.orderBy("doc_id").limit(n).select("doc_id", F.translate(F.substring("text", 1, width), "\n", " ").alias("preview"))
