import random

from spanlink.config import Config
from spanlink.operators import spans

CONFIG = Config()
SCHEMA = "doc_id long, ord int, label string, text string, confidence double, start int, end int, source string"
THRESHOLDS = {"event": 0.5, "location": 0.8, "date": 0.5, "food crisis": 0.4}


def loop(rows, thresholds=THRESHOLDS):
    """The rule told span by span."""
    accepted = []
    for r in sorted(rows, key=lambda r: (r["start"], r["label"] == "event", r["ord"])):
        if r["source"] != "gazetteer" and r["confidence"] < thresholds.get(r["label"], 0.3):
            continue
        hit = next((a for a in accepted if max(a["start"], r["start"]) < min(a["end"], r["end"])), None)
        if hit is None:
            accepted.append(dict(r))
        elif hit["label"] == "event" and r["label"] != "event":
            hit.update(label=r["label"], confidence=r["confidence"], source=r["source"])
    return [(a["start"], a["end"], a["label"], a["text"], round(a["confidence"], 4)) for a in accepted]


def run(spark, docs):
    df = spark.createDataFrame([(d, r["ord"], r["label"], r["text"], r["confidence"], r["start"], r["end"], r["source"]) for d, rows in docs.items() for r in rows], SCHEMA)
    got = {d: [] for d in docs}
    for r in spans.greedy_dedup(df, CONFIG).orderBy("doc_id", "ord").collect():
        got[r.doc_id].append((r.start, r.end, r.label, r.text, r.confidence))
    return got


def span(i, label, start, end, confidence=0.9, source="model"):
    return {"ord": i, "label": label, "text": f"t{i}", "confidence": confidence, "start": start, "end": end, "source": source}


def test_random_documents(spark):
    rnd = random.Random(8)
    docs = {}
    for d in range(150):
        rows = []
        for i in range(rnd.randint(1, 14)):
            s = rnd.randint(0, 40)
            rows.append(span(i, rnd.choice(["event", "location", "date", "food crisis", "thing"]), s, s + rnd.randint(1, 9), rnd.randint(0, 20) / 20, rnd.choice(["model", "model", "gazetteer"])))
        docs[d] = rows
    assert run(spark, docs) == {d: loop(rows) for d, rows in docs.items()}


def test_cases(spark):
    docs = {
        0: [span(0, "event", 0, 9), span(1, "location", 4, 12)],  # becomes a location with the event's text and offsets
        1: [span(0, "event", 0, 9), span(1, "food crisis", 4, 12, 0.2)],  # too unsure to upgrade
        2: [span(0, "event", 0, 5), span(1, "event", 5, 9)],  # touching spans are both kept
        3: [span(0, "event", 3, 9), span(1, "food crisis", 3, 9)],  # the specific one comes first
    }
    got = run(spark, docs)
    assert got[0] == [(0, 9, "location", "t0", 0.9)]
    assert got[1] == [(0, 9, "event", "t0", 0.9)]
    assert [g[:2] for g in got[2]] == [(0, 5), (5, 9)]
    assert got[3] == [(3, 9, "food crisis", "t1", 0.9)]


def test_merge_gazetteer_upgrades_the_first_overlap_only(spark):
    e = spark.createDataFrame([(1, 0, "location", "a", 0.9, 0, 5, "model"), (1, 1, "event", "b", 0.7, 6, 9, "model")], SCHEMA)
    g = spark.createDataFrame([(1, 0, "weather shocks", "x", 1.0, 3, 8, "gazetteer"), (1, 1, "weather shocks", "y", 1.0, 7, 8, "gazetteer"), (1, 2, "other", "z", 1.0, 20, 22, "gazetteer")], SCHEMA)
    got = [(r.label, r.text, r.confidence, r.source) for r in spans.merge_gazetteer(e, g).orderBy("start").collect()]
    assert got == [("location", "a", 0.9, "model"), ("weather shocks", "b", 1.0, "gazetteer"), ("other", "z", 1.0, "gazetteer")]


def test_merge_chunks_keeps_the_most_confident(spark):
    rows = [(1, 0, "event", "Flood", 0.5, 3, 8, "model", 0, 0), (1, 0, "event", "flood", 0.7, 1, 6, "model", 1, 100), (1, 1, "event", "flood", 0.7, 9, 14, "model", 1, 100)]
    df = spark.createDataFrame(rows, SCHEMA + ", chunk_idx int, c_start int")
    (r,) = spans.merge_chunks(df).collect()
    assert (r.start, r.end, r.confidence) == (101, 106, 0.7)
