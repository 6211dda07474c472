"""Linking events to locations. Entities have doc_id, ord, label, text, confidence, start, end; sentences doc_id, sent_idx, s_start, s_end, s_text.

Everything is keyed by document: windows and joins share one partitioning by doc_id. Pairs have the columns of PAIR.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.config import Config

PAIR = ["doc_id", "sent_idx", "event_text", "event_label", "event_start", "event_end", "event_confidence", "location_text", "location_start", "location_end", "location_confidence", "cross_sentence", "link_method"]
#: Code points of a bucket in which spans meet sentences.
BUCKET = 1024


def span_to_sentence(spans: DataFrame, sentences: DataFrame) -> DataFrame:
    """spans with the sent_idx and s_text of the sentence in which they start; spans between sentences are dropped.

    Both sides are put into buckets of offsets, so a long document's spans meet the few sentences near them.
    """
    s = sentences.select("doc_id", "sent_idx", "s_start", "s_end", "s_text", F.explode(F.sequence(F.floor(F.col("s_start") / BUCKET), F.floor(F.greatest(F.col("s_end") - 1, F.col("s_start")) / BUCKET))).alias("__b"))
    x = spans.withColumn("__b", F.floor(F.col("start") / BUCKET)).join(s, ["doc_id", "__b"])
    return x.filter("s_start <= start and start < s_end").drop("__b")


def _best(order: list[Column], value: Column) -> Column:
    return F.max_by(value, F.struct(*order))


def _loc() -> Column:
    return F.struct(F.col("text").alias("text"), F.col("start").alias("start"), F.col("end").alias("end"), F.col("confidence").alias("confidence"))


def _pairs(df: DataFrame, loc: str = "loc") -> DataFrame:
    """Rows of an event and a location struct as pairs, the first one of each texts and label of a document."""
    w = Window.partitionBy("doc_id", F.lower("text"), F.lower(f"{loc}.text"), "label").orderBy("sent_idx", "ord", "__k")
    x = df.withColumn("__n", F.row_number().over(w)).filter("__n = 1")
    return x.select(
        "doc_id", "sent_idx", F.col("text").alias("event_text"), F.col("label").alias("event_label"), F.col("start").alias("event_start"), F.col("end").alias("event_end"), F.col("confidence").alias("event_confidence"),
        F.col(f"{loc}.text").alias("location_text"), F.col(f"{loc}.start").alias("location_start"), F.col(f"{loc}.end").alias("location_end"), F.col(f"{loc}.confidence").alias("location_confidence"),
        F.col("__cross").alias("cross_sentence"), F.col("__method").alias("link_method"),
    )


def _split(entities: DataFrame, sentences: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    at = span_to_sentence(entities, sentences)
    events = at.filter(F.col("label").isin(*config.event_labels)).select("doc_id", "sent_idx", "ord", "label", "text", "start", "end", "confidence")
    return events, at.filter("label = 'location'")


def link_all(entities: DataFrame, sentences: DataFrame, config: Config) -> DataFrame:
    """Each event with every location of its sentence."""
    events, locs = _split(entities, sentences, config)
    l = locs.select("doc_id", "sent_idx", F.col("ord").alias("__k"), _loc().alias("loc"))
    return _pairs(events.join(l, ["doc_id", "sent_idx"]).withColumns({"__cross": F.lit(False), "__method": F.lit("same_sentence")}))


def link_neighbor(entities: DataFrame, sentences: DataFrame, config: Config) -> DataFrame:
    """Each event with every location of its sentence; without any, of the sentence before; without any, of the one behind."""
    events, locs = _split(entities, sentences, config)
    here = locs.groupBy("doc_id", "sent_idx").agg(F.array_sort(F.collect_list(F.struct("ord", _loc().alias("loc")))).alias("locs"))
    w = Window.partitionBy("doc_id").orderBy("sent_idx")
    s = sentences.select("doc_id", "sent_idx").join(here, ["doc_id", "sent_idx"], "left")
    near = F.coalesce(F.when(F.lag("sent_idx").over(w) == F.col("sent_idx") - 1, F.lag("locs").over(w)), F.when(F.lead("sent_idx").over(w) == F.col("sent_idx") + 1, F.lead("locs").over(w)))
    s = s.withColumns({"__near": near}).select("doc_id", "sent_idx", F.col("locs").isNull().alias("__cross"), F.coalesce("locs", "__near").alias("locs"))
    x = events.join(s, ["doc_id", "sent_idx"]).withColumn("l", F.explode("locs"))
    x = x.select("doc_id", "sent_idx", "ord", "label", "text", "start", "end", "confidence", "__cross", F.when(F.col("__cross"), "neighbor").otherwise("same_sentence").alias("__method"), F.col("l.ord").alias("__k"), F.col("l.loc").alias("loc"))
    return _pairs(x)


def _carried(sentences: DataFrame, locs: DataFrame) -> DataFrame:
    """Sentences with the most confident location here, the last one so far, and the first one so far."""
    best = locs.groupBy("doc_id", "sent_idx").agg(_best([F.col("confidence"), -F.col("ord")], _loc()).alias("here"))
    w = Window.partitionBy("doc_id").orderBy("sent_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = sentences.select("doc_id", "sent_idx", "s_text").join(best, ["doc_id", "sent_idx"], "left")
    return s.withColumns({"active": F.last("here", ignorenulls=True).over(w), "first": F.first("here", ignorenulls=True).over(w)})


def link_waterfall(entities: DataFrame, sentences: DataFrame, config: Config) -> DataFrame:
    """Each event with every location of its sentence; without any, with the most confident one of the last sentence that has some."""
    events, locs = _split(entities, sentences, config)
    s = _carried(sentences, locs)
    same = events.join(locs.select("doc_id", "sent_idx", F.col("ord").alias("__k"), _loc().alias("loc")), ["doc_id", "sent_idx"]).withColumns({"__cross": F.lit(False), "__method": F.lit("same_sentence")})
    fell = events.join(s.filter("here is null and active is not null").select("doc_id", "sent_idx", F.col("active").alias("loc")), ["doc_id", "sent_idx"])
    fell = fell.withColumns({"__k": F.lit(0), "__cross": F.lit(True), "__method": F.lit("waterfall")})
    return _pairs(same.unionByName(fell))


def _nearest(events: DataFrame, locs: DataFrame) -> DataFrame:
    """The location of the sentence that starts nearest to each event, the first one at equal distance."""
    l = locs.select("doc_id", "sent_idx", F.col("ord").alias("__k"), _loc().alias("loc"))
    x = events.join(l, ["doc_id", "sent_idx"])
    w = Window.partitionBy("doc_id", "sent_idx", "ord").orderBy(F.abs(F.col("loc.start") - F.col("start")), "__k")
    return x.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n").withColumns({"__cross": F.lit(False), "__method": F.lit("same_sentence")})


def link_nearest(entities: DataFrame, sentences: DataFrame, config: Config) -> DataFrame:
    """Each event with the nearest location of its sentence; without any, in a sentence about the whole area, with the best one of the
    first sentence that has some; else with the last one so far."""
    events, locs = _split(entities, sentences, config)
    s = _carried(sentences, locs).filter("here is null and active is not null")
    macro = F.col("s_text").rlike(config.macro)
    s = s.select("doc_id", "sent_idx", F.when(macro, F.col("first")).otherwise(F.col("active")).alias("loc"), F.when(macro, "macro").otherwise("waterfall").alias("__method"))
    far = events.join(s, ["doc_id", "sent_idx"]).withColumns({"__k": F.lit(0), "__cross": F.lit(True)})
    return _pairs(_nearest(events, locs).unionByName(far))


# Forms that the rules of verb_forms() don't give.
IRREGULAR = {"flee": ["fled"], "leave": ["left"], "drive": ["drove", "driven"], "seek": ["sought"], "expel": ["expelled", "expelling"]}


def verb_forms(verb: str) -> list[str]:
    """A verb's forms: present, past and participles."""
    third = verb + ("es" if verb.endswith(("s", "x", "z", "ch", "sh")) else "s")
    past = verb + ("d" if verb.endswith("e") else "ed")
    silent = verb.endswith("e") and not verb.endswith(("ee", "oe", "ye"))
    return [verb, third, past, (verb[:-1] if silent else verb) + "ing", *IRREGULAR.get(verb, [])]


def _forms(verbs: tuple[str, ...]) -> str:
    """A pattern of the verbs' forms."""
    return "|".join(form for v in verbs for form in verb_forms(v))


def role(sentence: Column, start: Column, config: Config) -> Column:
    """SOURCE, DESTINATION or LOCATION by the preposition in front of a span that starts at start of the sentence.

    "in" takes the side of the last verb in front of it that has one.
    """
    front = F.lower(F.substring(sentence, F.lit(1), start))
    preposition = F.regexp_extract(front, r"(?U)(?:^|\s)(from|to|into|in)\s+(?:the\s+)?$", 1)
    source, target = _forms(config.source_verbs), _forms(config.destination_verbs)
    verb = F.regexp_extract(front, rf"(?Us)^.*\b({source}|{target})\b", 1)
    side = F.when(verb == "", "LOCATION").when(verb.rlike(f"^(?:{source})$"), "SOURCE").otherwise("DESTINATION")
    return F.when(preposition == "from", "SOURCE").when(preposition.isin("to", "into"), "DESTINATION").when(preposition == "in", side).otherwise("LOCATION")


def roles(spans: DataFrame, sentences: DataFrame, config: Config) -> DataFrame:
    """spans in sentences with their role."""
    at = span_to_sentence(spans, sentences)
    return at.withColumn("role", role(F.col("s_text"), F.col("start") - F.col("s_start"), config))


def coref_locations(locs: DataFrame, coref: DataFrame, sentences: DataFrame) -> DataFrame:
    """(doc_id, sent_idx, loc): the most confident location that a sentence's mentions resolve to.

    A mention's antecedent resolves to the first of the document's locations, one for each text, that contains it or that it contains.
    """
    t = locs.withColumn("__key", F.lower("text"))
    known = t.groupBy("doc_id", "__key").agg(F.min("ord").alias("__first"), _best([F.col("confidence"), -F.col("ord")], _loc()).alias("loc"))
    x = coref.join(known, "doc_id").filter("(loc.start >= a_start and loc.end <= a_end) or (a_start >= loc.start and a_end <= loc.end)")
    w = Window.partitionBy("doc_id", "m_start", "m_end").orderBy("__first")
    x = x.withColumn("__n", F.row_number().over(w)).filter("__n = 1")
    x = span_to_sentence(x.select("doc_id", F.col("m_start").alias("start"), "m_end", "loc"), sentences)
    return x.groupBy("doc_id", "sent_idx").agg(_best([F.col("loc.confidence"), -F.col("start"), -F.col("m_end")], F.col("loc")).alias("loc"))


def major_location(locs: DataFrame) -> DataFrame:
    """(doc_id, loc): the most confident mention of each document's most frequent location text; the first text at equal counts."""
    t = locs.withColumn("__key", F.lower("text"))
    counts = t.groupBy("doc_id", "__key").agg(F.count("*").alias("n"), F.min("ord").alias("first"), _best([F.col("confidence"), -F.col("ord")], _loc()).alias("loc"))
    return counts.groupBy("doc_id").agg(_best([F.col("n"), -F.col("first")], F.col("loc")).alias("loc"))


def link_full(entities: DataFrame, sentences: DataFrame, config: Config, coref: DataFrame | None = None) -> DataFrame:
    """Each event with the nearest location of its sentence that its role allows; in a sentence without locations, with one that a
    mention resolves to; in one about the whole area, with the document's major location; else with the last one so far.

    config.skip says which events a destination is no place for: those that are sources ("source") or all ("any"). An event whose sentence
    has locations, but none that it may have, has no pair.
    """
    at = roles(entities, sentences, config)
    columns = ["doc_id", "sent_idx", "ord", "label", "text", "start", "end", "confidence"]
    events = at.filter(F.col("label").isin(*config.event_labels)).select(*columns, "role")
    locs = at.filter("label = 'location'")
    l = locs.select("doc_id", "sent_idx", F.col("ord").alias("__k"), _loc().alias("loc"), F.col("role").alias("loc_role"))
    x = events.join(l, ["doc_id", "sent_idx"])
    barred = (F.col("loc_role") == "DESTINATION") & (F.lit(True) if config.skip == "any" else F.col("role") == "SOURCE")
    w = Window.partitionBy("doc_id", "sent_idx", "ord").orderBy(F.abs(F.col("loc.start") - F.col("start")), "__k")
    same = x.filter(~barred).withColumn("__n", F.row_number().over(w)).filter("__n = 1").select(*columns, "__k", "loc")
    same = same.withColumns({"__cross": F.lit(False), "__method": F.lit("same_sentence")})

    s = _carried(sentences, locs).filter("here is null")
    resolved = coref_locations(locs, coref, sentences) if coref is not None else None
    s = s.join(resolved.withColumnRenamed("loc", "coref_loc"), ["doc_id", "sent_idx"], "left") if resolved is not None else s.withColumn("coref_loc", F.lit(None).cast(s.schema["active"].dataType))
    s = s.join(major_location(locs).withColumnRenamed("loc", "major"), "doc_id", "left")
    whole = F.col("s_text").rlike(config.macro) & F.col("major").isNotNull()
    loc = F.when(F.col("coref_loc").isNotNull(), F.col("coref_loc")).when(whole, F.col("major")).otherwise(F.col("active"))
    method = F.when(F.col("coref_loc").isNotNull() | whole, "coref").otherwise("waterfall")  # both are named alike
    s = s.select("doc_id", "sent_idx", loc.alias("loc"), method.alias("__method")).filter("loc is not null")
    far = events.select(*columns).join(s, ["doc_id", "sent_idx"]).withColumns({"__k": F.lit(0), "__cross": F.lit(True)})
    return _pairs(same.unionByName(far))


LINKERS = {"all": link_all, "neighbor": link_neighbor, "waterfall": link_waterfall, "nearest": link_nearest, "full": link_full}
