"""Entities with ids, typed relations, structured records and classes of documents, merged over chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of structured event records and of classes of documents.
EVENT_TYPES = ["natural_disaster", "armed_conflict", "political", "economic", "social_unrest", "accident", "ceremony", "health", "legal", "other"]
LOCATION_TYPES = ["city", "country", "region", "facility", "venue", "other"]
SEVERITIES = ["low", "medium", "high", "critical"]
SECTIONS = ["world", "politics", "business", "science", "sports", "environment"]
RECORD = "array<struct<event_name:string,event_type:string,location_name:string,location_type:string,severity:string>>"


def entity_ids(mentions: DataFrame) -> DataFrame:
    """(doc_id, id, text, label, start, end): one entity for each text in any case, whatever its label; the first mention's label, upper case.

    Ids are e1, e2 ... in the order of ord.
    """
    first = Window.partitionBy("doc_id", F.lower("text")).orderBy("ord")
    x = mentions.withColumn("__n", F.row_number().over(first)).filter("__n = 1")
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))
    return x.select("doc_id", F.concat(F.lit("e"), number).alias("id"), "text", F.upper("label").alias("label"), "start", "end")


def relations(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(doc_id, event_id, location_id, relation_type) of edges (doc_id, head, tail, relation_type) whose both ends are known entities."""
    e = entities.select("doc_id", F.lower("text").alias("__t"), "id")
    x = edges.withColumns({"__h": F.lower("head"), "__l": F.lower("tail")})
    x = x.join(e.select("doc_id", F.col("__t").alias("__h"), F.col("id").alias("event_id")), ["doc_id", "__h"])
    x = x.join(e.select("doc_id", F.col("__t").alias("__l"), F.col("id").alias("location_id")), ["doc_id", "__l"])
    return x.select("doc_id", "event_id", "location_id", "relation_type").distinct()


def merge_sets(mentions: DataFrame) -> DataFrame:
    """(doc_id, label, texts): the distinct mention texts of each label over all chunks, in the order of their first offset."""
    first = mentions.groupBy("doc_id", "label", "text").agg(F.min("start").alias("at"))
    return first.groupBy("doc_id", "label").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("x")).select("doc_id", "label", F.col("x.text").alias("texts"))


def merge_records(records: DataFrame) -> DataFrame:
    """(doc_id, records): the records of all chunks in order, duplicates from overlaps included.

    Values that aren't among the choices become "other", or null for severities.

    records has doc_id, chunk_idx and records, an array or its JSON.
    """
    r = F.from_json("records", RECORD) if dict(records.dtypes)["records"] == "string" else F.col("records")

    def chosen(x: Column) -> Column:
        x = x.withField("event_type", F.when(x["event_type"].isin(EVENT_TYPES), x["event_type"]).otherwise("other"))
        x = x.withField("location_type", F.when(x["location_type"].isin(LOCATION_TYPES), x["location_type"]).otherwise("other"))
        return x.withField("severity", F.when(x["severity"].isin(SEVERITIES), x["severity"]))

    known = F.transform(r, chosen)
    x = records.select("doc_id", F.struct("chunk_idx", known.alias("r")).alias("c"))
    return x.groupBy("doc_id").agg(F.flatten(F.array_sort(F.collect_list("c"))["r"]).alias("records"))


def first_class(classes: DataFrame) -> DataFrame:
    """(doc_id, class): the first class that isn't empty, in the order of chunk_idx."""
    x = classes.filter("coalesce(class, '') != ''")
    return x.groupBy("doc_id").agg(F.min_by("class", "chunk_idx").alias("class"))
