"""The corpus pipeline: stages over documents, each calling one operator of spanlink.llm.

A stage gets the documents that its predecessor kept, read from files, and returns those that it keeps with all
their columns (the last one returns token ids). For every stage: documents has doc_id, text and source; other columns are passed
on, whatever their names are. Rows are told apart by their place in the files, which is the same however these are split and
whichever executors there are; so repeated rows, and repeated and null doc_ids, are no problem. An empty table
gives an empty one. Texts are whole, however long they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.llm.bpe import bpe_encode
from spanlink.llm.common import cut, delete, free_name, identified, released, shared_dir, table
from spanlink.llm.exact_dedup import exact_dedup
from spanlink.llm.mixing import mix
from spanlink.llm.near_dedup import near_groups
from spanlink.llm.quality import resample

#: The public vocabulary of the last stage.
VOCABULARY = "byte_bpe_50k.json"


def _kept(docs: DataFrame, decide: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of docs that decide, given docs and the column that tells rows apart, keeps (rid, kept)."""
    numbered, rid = identified(docs)
    dropped = cut(decide(numbered, rid).filter("not kept").select(F.col("rid").alias(rid)))
    return numbered.join(dropped, rid, "left_anti").drop(rid)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that importance resampling keeps.

    A null or empty text weighs nothing and is kept if weight 0 is. Repeated rows are judged alike, but for ties at the
    last place of the sample, which the order of rows decides. Without labels of both kinds all documents stay.
    """
    return _kept(docs, lambda d, rid: resample(d, table(spark, sf_dir, "labels"), rid=rid))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of documents whose texts are identical but for white space: the longest, then the one with the smallest doc_id (null last).

    Null counts as empty, and empty texts are equal to each other. Of repeated rows one stays.
    """
    return _kept(docs, lambda d, rid: exact_dedup(d, rid=rid))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of each group of documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more: that with the
    smallest doc_id (null last).

    Candidates are chosen by operator 5's fingerprints, and by MinHash for the rest; what is similar is decided on whole sets.
    A text of fewer words is one shingle. Texts without words, or null, are equal to each other and to nothing else.
    Of repeated rows one stays.
    """
    return _kept(docs, lambda d, rid: near_groups(d, rid=rid))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; those that it doesn't take go.

    A null source is a source. A text without words, or null, is taken as often as its rank says, as it costs nothing. Repeated rows
    are ranked one after the other.
    """
    numbered, rid = identified(docs)
    times, copy = free_name(docs, "__copies"), free_name(docs, "__copy")
    copies = cut(mix(numbered, rid=rid).filter("copies > 0").select(F.col("rid").alias(rid), F.col("copies").cast("int").alias(times)))
    taken = numbered.join(copies, rid)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(rid, times, copy)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and text (decoded from ids) of each document.

    Null counts as empty, which has no tokens. Repeated rows give equal rows.
    """
    coded = bpe_encode(docs, public_tokenizers.path(VOCABULARY), packed=True, decoded=True)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("bpe encoding and decoding", tokenize),
]

#: SQL can't express fitting, SimHash, MinHash, Pareto sampling and BPE; tests hold the operators of the stages against brute-force versions one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; what a stage returns is written as Parquet in the shared folder and read again.

    A stage's checkpoints are deleted when its rows are written, and its input when the next one's are; the last one's rows stay.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        with released(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
