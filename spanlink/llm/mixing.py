"""Operator 7: mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A source whose target is r times its size gives each document floor(r) certain whole copies. The rest of
the target is a sample without replacement with inclusion probabilities lambda: documents are ranked by
random odds divided by inclusion odds, (u / (1 - u)) / (lambda / (1 - lambda)), and taken in that order until
the words of the rest are reached. Sampling in a fixed amount of words, not of rows, keeps a source near its target though
documents differ in length by orders of magnitude.

lambda falls slowly with a document's length, so that one long document rarely makes up much of a source: its odds are
those of the source times 2 ** (-step / 16), where step counts quarter octaves of the length. The odds of the source are
calibrated: with them the expected words of the sample are the rest of the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.llm.common import cut, row_id, skewed_join

#: What separates words.
SPACES = r"[\x20\x09-\x0D]+"
#: Bins of the rank in a source. The bin in which the target is met is divided again, LEVELS times in all; only in the last one are documents ordered one by one.
BINS, LEVELS = 256, 3


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    return (F.size(parts) - (F.element_at(parts, 1) == "").cast("int") - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("long")


def step(size: Column) -> Column:
    """Quarter octaves of 1 + size / 1000: 160 at 10^15 words."""
    return F.floor(4 * F.log2(1 + size / 1000)).cast("int")


def relative_odds(steps: Column) -> Column:
    return F.pow(F.lit(2.0), -steps / 16)


def calibrated(steps: Column, rest: Column) -> Column:
    """The log odds of a source at which its sample is expected to have rest words.

    steps is an array of (odds, words): the words of all its documents with these relative odds. Found by halving an interval.
    """

    def expected(log_odds: Column) -> Column:
        return F.aggregate(steps, F.lit(0.0), lambda words, s: words + s["words"] * (1 - 1 / (1 + s["odds"] * F.exp(log_odds))))

    def halve(found: Column, _: Column) -> Column:
        middle = (found["low"] + found["high"]) / 2
        less = expected(middle) < rest
        return F.struct(F.when(less, middle).otherwise(found["low"]).alias("low"), F.when(less, found["high"]).otherwise(middle).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.struct(F.lit(-50.0).alias("low"), F.lit(50.0).alias("high")), halve, lambda found: found["low"])


def targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) of each source.

    Sources in code point order, null last, have the weights in turn. They share ``share`` times all words by weight;
    none gets over ``most`` times its own, and what that leaves is shared by weight among the others. The level at
    which all is shared out is found at once: in the order of size by weight, each source is capped or none after it.
    """
    cycle = F.array(*[F.lit(float(x)) for x in weights])
    ranked = sizes.withColumn("__n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("__w", F.element_at(cycle, F.pmod(F.col("__n") - 1, F.lit(len(weights))) + 1)).withColumn("__cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("__cap") / F.col("__w"), "__n").rowsBetween(Window.unboundedPreceding, -1)
    x = ranked.withColumn("__total", F.sum("source_size").over(everything) * F.lit(float(share)))
    x = x.withColumn("__left", F.col("__total") - F.coalesce(F.sum("__cap").over(by_level), F.lit(0.0)))
    x = x.withColumn("__w_left", F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(by_level), F.lit(0.0)))
    x = x.withColumn("__level", F.col("__left") / F.col("__w_left"))
    x = x.withColumn("__capped", F.col("__cap") <= F.col("__level") * F.col("__w"))
    x = x.withColumn("__at", F.min(F.when(~F.col("__capped"), F.struct((F.col("__cap") / F.col("__w")).alias("c"), "__n", "__level"))).over(everything)["__level"])
    return x.select("source", "source_size", F.when(F.col("__capped"), F.col("__cap")).otherwise(F.col("__at") * F.col("__w")).alias("target"))


def mix(docs: DataFrame, weights: list[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7, bins: int = BINS, rid: str | None = None) -> DataFrame:
    """How often the mix takes each document: rid, doc_id, source, size, source_size, target, copies, taken.

    docs has doc_id, text and source; other columns are ignored. rid is the column of that name,
    which tells rows apart, or a number for each row. size is the number of words, taken is size times copies. A null text has no
    words; a null source is a source. The random numbers are hashes of doc_id, text and seed, so reruns
    agree, and equal rows are ranked one after the other. An empty table gives an empty result.
    """
    rows = docs.select(
        row_id(rid).alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text").cast("string")).alias("size"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.lit(seed)).alias("__h"),
    )
    rows = cut(rows)
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("__key")
    steps = rows.groupBy("source", step(F.col("size")).alias("__step")).agg(F.sum("size").alias("words"))
    per_source = F.collect_list(F.struct(relative_odds(F.col("__step")).alias("odds"), "words")).alias("__steps")  # a step each
    sizes = cut(steps.groupBy("source").agg(F.sum("words").alias("source_size"), per_source))
    sources = targets(sizes.select("source", "source_size"), list(weights), share, most).select(key, "*").join(sizes.select(key, "__steps"), "__key")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = sources.withColumn("__certain", F.floor(ratio)).withColumn("__rest", F.col("target") - F.col("__certain") * F.col("source_size"))
    sources = cut(sources.withColumn("__log_odds", calibrated(F.col("__steps"), F.col("__rest"))).drop("__steps"))

    keyed = rows.select(key, "*").drop("source")
    x = skewed_join(keyed, sources, ["__key"], spread=F.col("__h"))
    odds = F.exp("__log_odds") * relative_odds(step(F.col("size")))
    u = (F.shiftrightunsigned("__h", 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    q = (u / (1 - u)) / odds
    x = cut(x.withColumn("__q", F.when(F.col("__rest") > 0, q / (1 + q))))

    done = [x.filter("__q is null").withColumn("__more", F.lit(0))]
    left = x.filter("__q is not null").withColumn("__from", F.lit(0).cast("long"))
    columns = x.columns
    for _ in range(LEVELS):
        left = left.withColumn("__bin", F.least(F.floor(F.col("__q") * bins), F.lit(bins - 1)).cast("int"))
        sums = left.groupBy("__key", "__bin").agg(F.sum("size").alias("__sum"), F.first("__rest").alias("__rest"), F.first("__from").alias("__from"))
        upto = Window.partitionBy("__key").orderBy("__bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("__end", F.col("__from") + F.sum("__sum").over(upto)).withColumn("__start", F.col("__end") - F.col("__sum"))
        cuts = cut(sums.filter("__start < __rest and __end >= __rest").groupBy("__key").agg(F.min("__bin").alias("__cut"), F.min_by("__start", "__bin").alias("__from")))
        met = skewed_join(left.drop("__from"), cuts, ["__key"], "left", spread=F.col("__h"))
        # a source without a cut is taken whole
        far = met.filter("__cut is null or __bin != __cut").withColumn("__more", F.when(F.col("__cut").isNull(), 1).otherwise((F.col("__bin") < F.col("__cut")).cast("int")))
        done.append(far.select(*columns, "__more"))
        left = cut(met.filter("__bin = __cut").withColumn("__q", F.col("__q") * bins - F.col("__bin")).select(*columns, "__from"))
    order = Window.partitionBy("__key").orderBy("__q", "doc_id", "rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # of the document in which the target is met, the nearer of taking and leaving it
    near = left.withColumn("__upto", F.col("__from") + F.sum("size").over(order)).withColumn("__more", (F.col("__upto") - F.col("size") / 2 < F.col("__rest")).cast("int"))
    out = near.select(*columns, "__more")
    for part in done:
        out = out.unionByName(part)
    copies = (F.col("__certain") + F.col("__more")).cast("long")
    return out.select("rid", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
