import json

import pytest
from pyspark.sql import functions as F

from spanlink.config import Config
from spanlink.operators import segment
from spanlink.operators.backend import extract_all
from spanlink.plans import benchmark as b
from spanlink.plans.extract import extract_documents


class Words:
    """Says that each word in capitals is an event at the word behind it."""

    def __init__(self, name="words", loads=True):
        self.name, self.loads, self.warm = name, loads, False

    def warmup(self):
        if not self.loads:
            raise OSError("no weights")
        self.warm = True

    def extract(self, text):
        if not self.warm or "bad" in text:
            raise ValueError("bad text")
        w = text.split()
        events = [(x, y) for x, y in zip(w, w[1:], strict=False) if x.isupper()]
        return [(e, "event") for e, _ in events] + [(p, "location") for _, p in events], events

    def cleanup(self):
        self.warm = False


ARTICLES = [
    {"id": "a", "text": "FLOOD Avon and WAR Bree", "entities": [["flood", "event"], ["avon", "location"]], "event_location_pairs": [["flood", "avon"], ["war", "cale"]]},
    {"text": "bad", "entities": [["x", "event"]], "event_location_pairs": []},
    {"id": "c", "text": ""},
]


@pytest.fixture
def articles(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(ARTICLES))
    return b.annotated(spark, str(tmp_path / "a.json"))


def test_annotated(spark, tmp_path, articles):
    assert sorted(r.doc_id for r in articles.collect()) == ["a", "article_1", "c"]
    assert [r.doc_id for r in b.annotated(spark, str(tmp_path / "a.json"), 1).collect()] == ["a"]


def test_backend(spark, articles):
    got = {r.doc_id: r for r in extract_all(articles, Words).collect()}
    assert [tuple(p) for p in got["a"].pairs] == [("FLOOD", "Avon"), ("WAR", "Bree")] and got["a"].seconds > 0 and got["a"].error is None
    assert got["article_1"].error == "ValueError: bad text" and got["article_1"].pairs == [] and got["article_1"].seconds is None


def test_run(spark, tmp_path, articles, capsys):
    s = b.benchmark(spark, articles, {"words": Words, "broken": lambda: Words(loads=False)}, str(tmp_path / "out"))
    assert "broken failed" in capsys.readouterr().out
    (r,) = s.collect()
    assert (r.model, r.evaluated, r.errors) == ("words", 2, 1)
    assert (r.ent_tp, r.ent_fp, r.ent_fn) == (2, 2, 0) and (r.pair_tp, r.pair_fp, r.pair_fn) == (1, 1, 1)
    (x,) = spark.read.json(str(tmp_path / "out/all_results")).collect()
    assert x.articles_evaluated == 2 and x.pair_metrics.f1 == 0.5 and x.entity_metrics.f1 == 0.6667
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "out/report")).collect())
    assert "Generated: 20" in text and "| 1 | words |" in text


def test_relaxed_pairs_score_as_their_worse_side(spark, articles):
    rows = extract_all(articles.filter("doc_id = 'a'").withColumn("text", F.lit("FLOODS Avon WAR Nowhere")), Words)
    strict, relaxed = (b.article_counts(rows, articles.filter("doc_id = 'a'"), m).first() for m in ("strict", "relaxed"))
    assert (strict.pair_tp, relaxed.pair_tp) == (0, 1) and (strict.ent_tp, relaxed.ent_tp) == (1, 2)


def test_linkers_are_timed(spark, tmp_path):
    docs = spark.createDataFrame([(1, "A famine came from Avon. War was near.")], "doc_id long, text string")
    config = Config(gazetteer={"food crisis": ["famine"], "location": ["avon"]})
    entities, sentences = extract_documents(docs, config)["entities"], segment.sentences(docs)
    gold = spark.createDataFrame([(1, "famine", "avon")], "doc_id long, event string, location string")
    e = b.evaluate_linkers(docs, entities, sentences, gold, str(tmp_path), config, ["all", "full"])
    rows = {r.version: r for r in e.collect()}
    assert set(rows) == {"all", "full"} and all((r.tp, r.fp, r.fn, r.f1) == (1, 0, 0, 1.0) and r.seconds > 0 for r in rows.values())
    assert set(b.timings(e).first().timings) == {"all", "full"}
    lines = b.console(e.withColumn("seconds", F.when(F.col("version") == "all", F.col("seconds")))).split("\n")
    assert lines[0] == "PAIRS" and len({len(x) for x in lines[1:]}) == 1 and lines[3].startswith("all") and lines[4].endswith(" -")
