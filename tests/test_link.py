from dataclasses import replace

from spanlink.config import Config
from spanlink.operators import link, segment
from spanlink.plans.extract import document_records, extract_documents

CONFIG = Config()
TEXT = "Floods hit Avon in May. Famine followed. In the country drought spread. People fled from Bree to Cale, and war began. Siege of Dun. Then plague."
SCHEMA = "doc_id long, ord int, label string, text string, confidence double, start int, end int, source string"


def tables(spark, text=TEXT, names=("Avon", "Bree", "Cale", "Dun"), events=("Floods", "Famine", "drought", "war", "Siege", "plague"), confidence=None):
    found = sorted([(text.index(t), t, "location") for t in names] + [(text.index(t), t, "event") for t in events])
    rows = [(1, i, label, t, (confidence or {}).get(t, 0.9), s, s + len(t), "model") for i, (s, t, label) in enumerate(found)]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return spark.createDataFrame(rows, SCHEMA), segment.sentences(docs)


def pairs(df):
    return [(r.event_text, r.location_text, r.link_method) for r in df.orderBy("sent_idx", "event_start", "location_start").collect()]


def test_all(spark):
    assert pairs(link.link_all(*tables(spark), CONFIG)) == [("Floods", "Avon", "same_sentence"), ("war", "Bree", "same_sentence"), ("war", "Cale", "same_sentence"), ("Siege", "Dun", "same_sentence")]


def test_neighbor_prefers_the_sentence_before(spark):
    got = pairs(link.link_neighbor(*tables(spark), CONFIG))
    assert ("Famine", "Avon", "neighbor") in got and ("plague", "Dun", "neighbor") in got
    assert ("drought", "Bree", "neighbor") in got and ("drought", "Cale", "neighbor") in got


def test_waterfall_carries_the_most_confident(spark):
    got = pairs(link.link_waterfall(*tables(spark, confidence={"Avon": 0.8}), CONFIG))
    assert ("Famine", "Avon", "waterfall") in got and ("drought", "Avon", "waterfall") in got and ("plague", "Dun", "waterfall") in got


def test_nearest(spark):
    got = pairs(link.link_nearest(*tables(spark), CONFIG))
    assert ("war", "Cale", "same_sentence") in got and ("drought", "Avon", "macro") in got and ("Famine", "Avon", "waterfall") in got


def test_full_with_coreference(spark):
    entities, sentences = tables(spark)
    s = TEXT.index("Famine followed")
    coref = spark.createDataFrame([(1, s, s + 6, TEXT.index("Dun"), TEXT.index("Dun") + 3, "Dun")], "doc_id long, m_start int, m_end int, a_start int, a_end int, a_text string")
    got = pairs(link.link_full(entities, sentences, CONFIG, coref))
    assert ("Famine", "Dun", "coref") in got and ("drought", "Avon", "coref") in got and ("plague", "Dun", "waterfall") in got


def test_full_skips_destinations(spark):
    text = "War drove people to Cale."
    entities, sentences = tables(spark, text, ("Cale",), ("War",))
    assert pairs(link.link_full(entities, sentences, CONFIG)) == [("War", "Cale", "same_sentence")]
    assert pairs(link.link_full(entities, sentences, replace(CONFIG, skip="any"))) == []


def test_roles(spark):
    cases = {"They came from Bree.": "SOURCE", "They went into the Bree.": "DESTINATION", "They arrived in Bree.": "DESTINATION", "Thousands fled in Bree.": "SOURCE", "It rained in Bree.": "LOCATION", "Bree is far.": "LOCATION"}
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    rows = [(i, 0, "location", "Bree", 0.9, t.index("Bree"), t.index("Bree") + 4, "model") for i, t in enumerate(cases)]
    got = link.roles(spark.createDataFrame(rows, SCHEMA), segment.sentences(docs), CONFIG).orderBy("doc_id").collect()
    assert [r.role for r in got] == list(cases.values())


def test_forms_of_the_shipped_verbs(spark):
    """Every verb in its participle and past, and a verb in front of a line break; a noun that only begins like a verb has no side."""
    forms = {"flee": "fleeing fled", "escape": "escaping escaped", "leave": "leaving left", "drive": "driving drove driven", "expel": "expelling expelled", "force": "forcing forced", "displace": "displacing displaced", "evacuate": "evacuating evacuated"}
    others = {"arrive": "arriving arrived", "seek": "seeking sought", "reach": "reaches reached", "settle": "settling settled", "move": "moving moved", "shelter": "sheltering sheltered"}
    cases = [(f"People {f} in Bree.", "SOURCE") for x in forms.values() for f in x.split()] + [(f"People {f} in Bree.", "DESTINATION") for x in others.values() for f in x.split()]
    cases += [("line one\nthey fled in Bree.", "SOURCE"), ("The movement in Bree.", "LOCATION"), ("He fled and arrived in Bree.", "DESTINATION")]
    cases += [(f"They {v} in Bree.", "SOURCE") for v in CONFIG.source_verbs] + [(f"They {v} in Bree.", "DESTINATION") for v in CONFIG.destination_verbs]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    rows = [(i, 0, "location", "Bree", 0.9, t.index("Bree"), t.index("Bree") + 4, "model") for i, (t, _) in enumerate(cases)]
    got = {r.doc_id: r.role for r in link.roles(spark.createDataFrame(rows, SCHEMA), segment.sentences(docs), CONFIG).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(cases)] == cases


def test_repeated_pairs_are_linked_once(spark):
    text = "Flood in Avon. flood in Avon."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = [(1, 0, "event", "Flood", 0.9, 0, 5, "m"), (1, 1, "location", "Avon", 0.9, 9, 13, "m"), (1, 2, "event", "flood", 0.9, 15, 20, "m"), (1, 3, "location", "Avon", 0.9, 24, 28, "m")]
    assert link.link_nearest(spark.createDataFrame(rows, SCHEMA), segment.sentences(docs), CONFIG).count() == 1


def test_extraction_of_records(spark):
    docs = spark.createDataFrame([(1, "A famine struck. The epidemic and the civil war went on."), (2, None)], "doc_id long, text string")
    out = extract_documents(docs, CONFIG)
    assert {(r.text, r.label) for r in out["entities"].collect()} == {("famine", "food crisis"), ("epidemic", "pests and diseases"), ("civil war", "conflicts and violence")}
    records = {r.doc_id: r for r in document_records(docs, out["entities"], out["pairs"]).collect()}
    assert len(records) == 2 and records[1].document.text_length == 56 and records[2].entities is None


def test_no_rows(spark):
    entities, sentences = tables(spark)
    for f in link.LINKERS.values():
        assert f(entities.limit(0), sentences, CONFIG).count() == 0
