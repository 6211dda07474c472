"""JSON sources with fixed schemas, and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ARTICLES = "id string, text string, content string, text_length int"
GOLD = "id string, entities array<array<string>>, event_location_pairs array<array<string>>"
ANNOTATED = f"{GOLD}, text string"
MODELS = "name string, repo_id string, family string, params string, active_params string, total_params string, architecture string"


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON array or of JSON lines; a missing path fails at once."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, ARTICLES)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold by id; of repeated ids the last in the file counts."""
    g = _json(spark, path, GOLD).withColumn("__n", F.monotonically_increasing_id())
    return g.groupBy("id").agg(F.max_by(F.struct("entities", "event_location_pairs"), "__n").alias("g")).select("id", "g.*")


def read_annotated(spark: SparkSession, path: str) -> DataFrame:
    """Articles with text and gold in one row, in the file's order (ord); a missing id becomes article_ and its number, missing arrays empty ones."""
    x = _json(spark, path, ANNOTATED).withColumn("__n", F.monotonically_increasing_id())
    # a file is a dataset of articles, which its numbering reads as one
    x = x.withColumn("ord", F.row_number().over(Window.orderBy("__n")) - 1).drop("__n")
    return defaulted(x.withColumn("text", F.coalesce("text", F.lit(""))))


def defaulted(articles: DataFrame) -> DataFrame:
    """Articles (id, ord and gold arrays) with defaults for what is missing."""
    empty = F.array().cast("array<array<string>>")
    named = F.coalesce("id", F.format_string("article_%d", F.col("ord")))
    return articles.withColumns({"id": named, **{c: F.coalesce(c, empty) for c in ("entities", "event_location_pairs")}})


def with_gold(articles: DataFrame, gold: DataFrame) -> DataFrame:
    """Articles with their gold; without any, with empty arrays."""
    x = articles.join(gold, "id", "left")
    empty = F.array().cast("array<array<string>>")
    return x.withColumns({c: F.coalesce(c, empty) for c in ("entities", "event_location_pairs")})


def gold_rows(gold: DataFrame, column: str, names: tuple[str, str]) -> DataFrame:
    """(id, first, second) of a column of two-element arrays, lower case and distinct for texts."""
    x = gold.select("id", F.explode(column).alias("x"))
    second = F.col("x")[1] if names[1] == "category" else F.lower(F.col("x")[1])
    return x.select("id", F.lower(F.col("x")[0]).alias(names[0]), second.alias(names[1])).distinct()


def read_models(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Registries of models, in arrays or under the key models, as one table with ord, their place in the order of paths.

    Sizes are numbers in some files and strings in others; both are read as strings.
    """
    parts = []
    for i, path in enumerate(paths):
        x = spark.read.schema(f"{MODELS}, models array<struct<{MODELS}>>").json(path, multiLine=True)
        one = x.select(F.explode(F.when(F.col("models").isNotNull(), F.col("models")).otherwise(F.array(F.struct(*[c.split(" ")[0] for c in MODELS.split(", ")])))).alias("m"))
        parts.append(one.select("m.*", (F.lit(i) * F.lit(1 << 40) + F.monotonically_increasing_id()).alias("ord")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """Rows as JSON lines; null fields are left out, so a flag that is null when false isn't written."""
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).json(path)
