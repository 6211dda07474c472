"""The whole extraction: documents to entities, pairs and records."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlink.config import Config
from spanlink.operators import segment, spans
from spanlink.operators.corpus import spread
from spanlink.operators.link import LINKERS, link_full
from spanlink.operators.mentions import lexicon_mentions, lexicon_table


def numbered(mentions: DataFrame) -> DataFrame:
    """mentions with ord, their order in the document by start, end and label."""
    return mentions.withColumn("ord", F.row_number().over(Window.partitionBy("doc_id").orderBy("start", "end", "label", "text")) - 1)


def extract_documents(docs: DataFrame, config: Config, mentions: DataFrame | None = None, coref: DataFrame | None = None) -> dict[str, DataFrame]:
    """sentences, entities and pairs of docs (doc_id, text).

    mentions are those of a model (MENTION columns); the gazetteer's are added before or after overlaps are removed, or not at all.
    """
    spark = docs.sparkSession
    found = mentions
    if config.gazetteer_mode != "none":
        terms = lexicon_mentions(docs, lexicon_table(spark, config.gazetteer))
        terms = terms.withColumns({"confidence": F.lit(1.0), "source": F.lit("gazetteer")})
        if config.gazetteer_mode == "pre" or mentions is None:
            found = terms if found is None else found.unionByName(terms.select(*found.columns))
    if found is None:
        raise ValueError("there are neither mentions nor a gazetteer")
    entities = spans.greedy_dedup(numbered(found), config)
    if config.gazetteer_mode == "post" and mentions is not None:
        entities = spans.merge_gazetteer(entities, numbered(terms))
    sentences = segment.sentences(docs)
    pairs = link_full(entities, sentences, config, coref) if config.linker == "full" else LINKERS[config.linker](entities, sentences, config)
    return {"sentences": sentences, "entities": entities, "pairs": pairs}


def document_records(docs: DataFrame, entities: DataFrame, pairs: DataFrame) -> DataFrame:
    """One nested record a document: document, entities, event_location_pairs. A document without an id gets a random one.

    cross_sentence is null where it's false, so JSON sinks leave it out. publication_date stays a string.
    """
    e = entities.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "label", "text", "confidence", "source"))).alias("entities"))
    cross = F.when(F.col("cross_sentence"), True).alias("cross_sentence")
    p = pairs.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sent_idx", "event_start", "event_text", "event_label", "location_text", "location_start", cross, "link_method"))).alias("event_location_pairs"))
    known = set(docs.columns)
    head = F.struct(
        F.coalesce(F.col("doc_id").cast("string"), F.uuid()).alias("id"),
        (F.col("source_url") if "source_url" in known else F.lit(None).cast("string")).alias("source_url"),
        (F.col("publication_date") if "publication_date" in known else F.lit(None).cast("string")).alias("publication_date"),
        F.length(F.coalesce("text", F.lit(""))).alias("text_length"),
    )
    x = docs.withColumn("document", head).join(e, "doc_id", "left").join(p, "doc_id", "left")
    return x.select("doc_id", "document", "entities", "event_location_pairs")


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Extracts events and their locations from documents (Parquet with doc_id and text).")
    p.add_argument("--dataset", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--linker", choices=list(LINKERS), default="full")
    p.add_argument("--max-articles", type=int)
    a = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    docs = spread(spark.read.parquet(a.dataset))
    if a.max_articles:
        docs = docs.orderBy("doc_id").limit(a.max_articles)
    out = extract_documents(docs, Config(linker=a.linker))
    document_records(docs, out["entities"], out["pairs"]).write.mode("overwrite").json(a.output)


if __name__ == "__main__":
    main()
