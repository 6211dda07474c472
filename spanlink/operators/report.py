"""Leaderboards over runs of models, and their report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanlink.functions.metrics import efficiency, per_minute, scores


def unique_models(models: DataFrame) -> DataFrame:
    """The first model of each name in the order of ord, whatever its repository."""
    w = Window.partitionBy("name").orderBy("ord")
    return models.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def select_models(models: DataFrame, wanted: list[str]) -> DataFrame:
    return models.filter(F.col("name").isin(wanted) | F.col("repo_id").isin(wanted))


def run_summary(runs: DataFrame) -> DataFrame:
    """One row a model of runs (model, doc_id, seconds, failed and ent_ and pair_ tp, fp, fn): failed documents count as errors only."""
    ok = ~F.col("failed")
    total = F.coalesce(F.sum(F.when(ok, F.col("seconds"))), F.lit(0.0))
    sums = [F.coalesce(F.sum(F.when(ok, F.col(f"{k}_{c}"))), F.lit(0)).alias(f"{k}_{c}") for k in ("ent", "pair") for c in ("tp", "fp", "fn")]
    x = runs.groupBy("model").agg(F.count_if(ok).alias("evaluated"), F.count_if("failed").alias("errors"), total.alias("total_s"), *sums)
    x = x.withColumn("avg_s", F.when(F.col("evaluated") > 0, F.col("total_s") / F.col("evaluated")).otherwise(F.lit(0.0)))
    for k in ("ent", "pair"):
        x = x.withColumns({f"{k}_{n}": c for n, c in scores(f"{k}_tp", f"{k}_fp", f"{k}_fn").items()})
    return x.withColumns({"efficiency": efficiency(F.col("pair_f1"), F.col("avg_s")), "per_minute": per_minute(F.col("avg_s"))})


def leaderboard(summary: DataFrame, by: str, ascending: bool = False) -> DataFrame:
    """summary with rank by a column; ties by model name. There is one row a model, so ranking is one small task."""
    order = F.asc(by) if ascending else F.desc(by)
    return summary.withColumn("rank", F.row_number().over(Window.orderBy(order, "model")))


def champions(summary: DataFrame) -> DataFrame:
    """The models with the best entity and pair scores, the least time (failed runs have none) and the best efficiency."""
    best = [F.min_by("model", F.struct(-F.col(c) if down else F.col(c), "model")).alias(n) for n, c, down in (("best_entities", "ent_f1", True), ("best_pairs", "pair_f1", True), ("fastest", "avg_s", False), ("most_efficient", "efficiency", True))]
    return summary.agg(*best)


def markdown(summary: DataFrame, title: str, stamped: bool = False) -> str:
    """The report of a summary, with the time it was made at if stamped; one row a model comes to the driver."""
    lines = [f"# {title}", ""]
    if stamped:
        at = summary.sparkSession.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm")).first()[0]
        lines += [f"Generated: {at}", ""]
    for head, by, ascending in (("Entities", "ent_f1", False), ("Pairs", "pair_f1", False), ("Speed", "avg_s", True)):
        lines += [f"## {head}", "", "| Rank | Model | Precision | Recall | F1 | s/article | articles/min |", "|---|---|---|---|---|---|---|"]
        kind = "ent" if by == "ent_f1" else "pair"
        for r in leaderboard(summary, by, ascending).orderBy("rank").collect():
            lines.append(f"| {r['rank']} | {r['model']} | {r[f'{kind}_precision']:.4f} | {r[f'{kind}_recall']:.4f} | {r[f'{kind}_f1']:.4f} | {r['avg_s']:.3f} | {r['per_minute']:.1f} |")
        lines.append("")
    c = champions(summary).first()
    lines += ["## Summary", "", *[f"- {n.replace('_', ' ')}: {c[n]}" for n in ("best_entities", "best_pairs", "fastest", "most_efficient")], ""]
    return "\n".join(lines)
