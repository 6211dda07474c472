"""Benchmarks: models over annotated articles, and the linkers over mentions, with scores, times, files and a table for the console.

What a model returns is written before it is scored, so each text is inferred once, whatever is lost later.
"""

from __future__ import annotations

import argparse
import importlib
import time
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.config import Config
from spanlink.operators import match, report, score
from spanlink.operators.backend import Backend, extract_all
from spanlink.operators.corpus import spread
from spanlink.operators.link import LINKERS, link_full
from spanlink.sources.json_files import read_annotated, read_models

COUNTS = ["tp", "fp", "fn"]
METRICS = ["precision", "recall", "f1", "f05", "f2", "jaccard"]


def _sides(rows: DataFrame, column: str, names: tuple[str, str]) -> DataFrame:
    """The distinct elements of an array of two values, lower case: (doc_id, names, id, both)."""
    x = rows.select("doc_id", F.explode(column).alias("x")).select("doc_id", *[F.lower(F.col("x")[n]).alias(n) for n in names]).distinct()
    return x.withColumns({"id": F.to_json(F.array(*names)), "both": F.struct(*names)})


def _matched(pred: DataFrame, gold: DataFrame, mode: str, pairs: bool) -> DataFrame:
    """(doc_id, tp) of a one-to-one match. Entities match within a category; a pair scores what the worse of its two sides does."""
    similar, column, least = match.MODES[mode]
    if column != "text":  # backends return none
        raise ValueError(f"mode {mode} needs embeddings; match them with operators.match")
    if pairs:
        by, column, value = ["doc_id"], "both", lambda a, b: F.least(similar(a["event"], b["event"]), similar(a["location"], b["location"]))
    else:
        by, value = ["doc_id", "category"], similar
    links = match.candidates(pred, gold, value, column, least, by)
    return match._assigned(links, by).groupBy("doc_id").agg(F.count("*").alias("tp"))


def article_counts(extracted: DataFrame, gold: DataFrame, mode: str = "strict") -> DataFrame:
    """A row an article: doc_id, seconds, failed, pred_, gold_ and counts of entities and pairs.

    extracted has EXTRACTED's columns; gold has doc_id, entities and pairs likewise. An article on which the model failed counts as failed
    only. Repeated elements count once.
    """
    out = extracted.select("doc_id", "seconds", F.col("error").isNotNull().alias("failed"))
    for kind, short, column, names in (("entities", "ent", "entities", ("text", "category")), ("pairs", "pair", "pairs", ("event", "location"))):
        p, g = _sides(extracted, column, names), _sides(gold, column, names)
        hits = _matched(p, g, mode, kind == "pairs")
        for x, name in ((p, f"pred_{kind}"), (g, f"gold_{kind}")):
            out = out.join(x.groupBy("doc_id").agg(F.count("*").alias(name)), "doc_id", "left")
        out = out.join(hits.withColumnRenamed("tp", f"{short}_tp"), "doc_id", "left").fillna(0, [f"pred_{kind}", f"gold_{kind}", f"{short}_tp"])
        out = out.withColumns({f"{short}_fp": F.col(f"pred_{kind}") - F.col(f"{short}_tp"), f"{short}_fn": F.col(f"gold_{kind}") - F.col(f"{short}_tp")})
    return out


def run_record(summary: DataFrame) -> DataFrame:
    """A row a model of report.run_summary(): articles, errors, times (2 and 3 places) and both metrics (4 places).

    What it says of each article is a table of its own, as a run may have any number of them.
    """

    def metrics(kind: str) -> Column:
        return F.struct(*[F.col(f"{kind}_{c}").alias(c) for c in COUNTS], *[F.bround(f"{kind}_{m}", 4).alias(m) for m in METRICS])

    return summary.select(
        "model", F.col("evaluated").alias("articles_evaluated"), "errors", F.bround("total_s", 2).alias("total_inference_time_s"), F.bround("avg_s", 3).alias("avg_inference_time_s"),
        metrics("ent").alias("entity_metrics"), metrics("pair").alias("pair_metrics"),
    )


def benchmark(spark: SparkSession, articles: DataFrame, models: dict[str, Callable[[], Backend]], output: str, mode: str = "strict") -> DataFrame:
    """Runs models over articles (doc_id, text, entities, pairs) and returns report.run_summary() of them.

    Below output it writes extracted and articles (a folder a model), all_results (a row a model) and the report. A model that
    doesn't run is left out and named in what is printed.
    """
    done = []
    for i, (name, load) in enumerate(models.items()):
        path = f"{output}/extracted/{i}"
        try:
            extract_all(articles, load).write.mode("overwrite").parquet(path)
        except PySparkException as e:
            print(f"{name} failed: {str(e)[:200]}")
            continue
        one = article_counts(spark.read.parquet(path), articles, mode).withColumn("model", F.lit(name))
        one.write.mode("overwrite").json(f"{output}/articles/{i}", ignoreNullFields=False)
        done.append(spark.read.schema(one.schema).json(f"{output}/articles/{i}"))
    if not done:
        raise ValueError("no model ran")
    summary = report.run_summary(reduce(DataFrame.unionByName, done))
    run_record(summary).coalesce(1).write.mode("overwrite").json(f"{output}/all_results")
    text = spark.createDataFrame([(report.markdown(summary, f"Benchmark, {mode} matches", stamped=True),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{output}/report")
    return summary


def evaluate_linkers(docs: DataFrame, entities: DataFrame, sentences: DataFrame, gold: DataFrame, output: str, config: Config, linkers: list[str] | None = None, coref: DataFrame | None = None) -> DataFrame:
    """evaluation() of the linkers' pairs against gold (doc_id, event, location; lower case), with the seconds that each one took to write them.

    The pairs stay below output, a folder a linker.
    """
    spark, keys, out = docs.sparkSession, ["doc_id", "event", "location"], []
    for name in linkers or list(LINKERS):
        began = time.perf_counter()
        pairs = link_full(entities, sentences, config, coref) if name == "full" else LINKERS[name](entities, sentences, config)
        pairs.write.mode("overwrite").parquet(f"{output}/{name}")
        seconds = time.perf_counter() - began
        pred = spark.read.parquet(f"{output}/{name}").select("doc_id", F.lower("event_text").alias("event"), F.lower("location_text").alias("location"))
        counted = score.per_document(pred, gold, keys, docs)
        out.append(counted.select(F.lit(name).alias("version"), F.lit("pairs").alias("kind"), *COUNTS, F.lit(seconds).alias("seconds")))
    return evaluation(reduce(DataFrame.unionByName, out))


def evaluation(counts: DataFrame) -> DataFrame:
    """One schema for all evaluations: kind, version, documents, counts, metrics (4 places) and seconds (2 places).

    counts has version, kind, tp, fp, fn and seconds (of the whole version, or null) a document.
    """
    sums = [F.sum(c).alias(c) for c in COUNTS]
    x = counts.groupBy("kind", "version").agg(F.count("*").alias("documents"), *sums, F.max("seconds").alias("seconds")).withColumns(score.scores())
    return x.select("kind", "version", "documents", *COUNTS, *[F.bround(m, 4).alias(m) for m in METRICS], F.bround("seconds", 2).alias("seconds"))


def timings(evaluated: DataFrame) -> DataFrame:
    """(kind, timings): seconds by version as a map; a version without seconds isn't in it. There is one row a version."""
    entry = F.struct("version", "seconds")
    return evaluated.filter("seconds is not null").groupBy("kind").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("timings"))


def console(evaluated: DataFrame) -> str:
    """evaluation() as tables of fixed width, one a kind; a row a version comes to the driver."""
    head = "{:<14} | {:>7} {:>7} {:>7} | ".format("Version", "TP", "FP", "FN") + " ".join(f"{n:>6}" for n in ("Prec", "Rec", "F1", "F0.5", "F2", "Jacc")) + f" | {'Time':>8}"
    took = F.when(F.col("seconds").isNull(), "-").otherwise(F.format_string("%.1fs", "seconds"))
    line = F.format_string("%-14s | %7d %7d %7d | " + " ".join(["%6.3f"] * 6) + " | %8s", "version", *COUNTS, *METRICS, took)
    lines, kind = [], None
    for r in evaluated.select("kind", line.alias("line")).orderBy("kind", "line").collect():
        if r.kind != kind:
            lines += ["", r.kind.upper(), head, "-" * len(head)]
        kind = r.kind
        lines.append(r.line)
    return "\n".join(lines[1:])


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Benchmarks model backends over annotated articles.")
    p.add_argument("--registry", action="append", required=True, help="a JSON registry of models; may be repeated")
    p.add_argument("--backend", required=True, help="module:function, which gets a model of the registry as a dict and returns its backend")
    p.add_argument("--models", help="names or repositories, separated by commas (default: all)")
    p.add_argument("--dataset", required=True)
    p.add_argument("--max-articles", type=int)
    p.add_argument("--match-mode", choices=["strict", "relaxed"], default="relaxed")
    p.add_argument("--output", required=True)
    a = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    module, function = a.backend.split(":")
    make = getattr(importlib.import_module(module), function)
    chosen = report.unique_models(read_models(spark, a.registry))
    if a.models:
        chosen = report.select_models(chosen, a.models.split(","))
    rows = [r.asDict() for r in chosen.orderBy("ord").collect()]  # a registry's rows
    if not rows:
        raise SystemExit("no models selected")
    summary = benchmark(spark, annotated(spark, a.dataset, a.max_articles), {r["name"]: (lambda r=r: make(r)) for r in rows}, a.output, a.match_mode)
    report.leaderboard(summary, "pair_f1").orderBy("rank").select("rank", "model", "ent_f1", "pair_f1", "avg_s", "efficiency").show(truncate=False)


def annotated(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """Articles of a dataset with doc_id, text, and gold entities and pairs; the first most ones."""
    x = read_annotated(spark, path)
    if most:
        x = x.filter(F.col("ord") < most)
    two = lambda c, a, b: F.transform(c, lambda v: F.struct(v[0].alias(a), v[1].alias(b)))
    x = x.select(F.col("id").alias("doc_id"), "text", two("entities", "text", "category").alias("entities"), two("event_location_pairs", "event", "location").alias("pairs"))
    return spread(x)


if __name__ == "__main__":
    main()
