import json

import pytest
from pyspark.sql import functions as F

from spanlink.config import Config
from spanlink.operators import corpus, graph, mentions
from spanlink.sources import json_files as J
from spanlink.streaming.documents import extract_stream


def test_articles_and_gold(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1", "text": "x"}, {"id": "2", "content": "y"}, {"id": "3"}]))
    (tmp_path / "g.json").write_text(json.dumps([{"id": "1", "entities": [["Old", "date"]], "event_location_pairs": []}, {"id": "1", "entities": [["Avon", "location"]], "event_location_pairs": [["War", "Avon"]]}]))
    gold = J.read_gold(spark, str(tmp_path / "g.json"))
    x = {r.id: r for r in J.with_gold(J.read_articles(spark, str(tmp_path / "a.json")), gold).collect()}
    assert x["1"].entities == [["Avon", "location"]] and x["2"].entities == [] and len(x) == 3
    assert [tuple(r) for r in J.gold_rows(gold, "entities", ("text", "category")).collect()] == [("1", "avon", "location")]
    with pytest.raises(Exception):
        J.read_articles(spark, str(tmp_path / "none.json")).collect()


def test_annotated_articles(spark, tmp_path):
    rows = [{"id": "7", "text": "x", "entities": [["Avon", "location"]], "event_location_pairs": [["War", "Avon"]]}, {"text": "y"}, {"id": "9", "entities": []}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    got = [tuple(r) for r in J.read_annotated(spark, str(tmp_path / "a.json")).orderBy("ord").select("id", "text", "entities", "event_location_pairs").collect()]
    assert got == [("7", "x", [["Avon", "location"]], [["War", "Avon"]]), ("article_1", "y", [], []), ("9", "", [], [])]


def test_record_choices(spark):
    c = '[{"event_name":"a","event_type":"armed_conflict","location_name":"l","location_type":"planet","severity":"deadly"},{"event_name":"b","event_type":"war","location_name":"l","location_type":"city","severity":"low"}]'
    got = graph.merge_records(spark.createDataFrame([(1, 0, c)], "doc_id long, chunk_idx int, records string")).first().records
    assert [(r.event_type, r.location_type, r.severity) for r in got] == [("armed_conflict", "other", None), ("other", "city", "low")]


def test_cap_counts_rows_that_are_seen(spark):
    docs = spark.createDataFrame([(i, "short" if i < 3 else "the and for with " * 40) for i in range(6)], "doc_id long, text string")
    assert [r.doc_id for r in corpus.corpus_filter(corpus.seen(docs, 4)).collect()] == [3]


def test_model_registries(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"models": [{"name": "m", "repo_id": "r/m", "params": 7}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"name": "m", "repo_id": "s/m", "params": "754B (MoE)"}, {"name": "n", "repo_id": "s/n", "total_params": "9B"}]))
    from spanlink.operators.report import select_models, unique_models

    models = J.read_models(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")])
    got = {r.name: (r.repo_id, r.params, r.total_params) for r in unique_models(models).collect()}
    assert got == {"m": ("r/m", "7", None), "n": ("s/n", None, "9B")}
    assert {r.name for r in select_models(models, ["s/n"]).collect()} == {"n"}


def test_false_flags_are_not_written(spark, tmp_path):
    J.write_json(spark.createDataFrame([(1, None), (2, True)], "id long, cross_sentence boolean"), str(tmp_path / "out"))
    lines = sorted(x for p in (tmp_path / "out").glob("*.json") for x in p.read_text().splitlines())
    assert lines == ['{"id":1}', '{"id":2,"cross_sentence":true}']


def test_corpus(spark):
    texts = ["the and for " * 40, "the and " + "x" * 400, "  " + "the with from was " * 20, "short the and for", None]
    docs = spark.createDataFrame([(i, t, "fallback") for i, t in enumerate(texts)], "doc_id long, text string, content string")
    assert {r.doc_id for r in corpus.corpus_filter(docs, "text", "content").collect()} == {0, 2}
    names = corpus.sample(docs, 3, 1).collect()
    assert sorted(r.name for r in names) == ["article_000", "article_001", "article_002"]
    assert names == corpus.sample(docs, 3, 1).collect()


@pytest.mark.parametrize("most", [0, 300])
def test_lexicon_is_whole_words(spark, monkeypatch, most):
    monkeypatch.setattr(mentions, "PATTERN_TERMS", most)  # both ways of searching
    docs = spark.createDataFrame([(1, "Floods and FLOOD, civil  war; civil war. food crisis crisis")], "doc_id long, text string")
    lex = mentions.lexicon_table(spark, {"w": ["flood", "civil war", "crisis", "food crisis"]})
    got = {(r.text, r.start, r.end) for r in mentions.lexicon_mentions(docs, lex).collect()}
    assert got == {("FLOOD", 11, 16), ("civil war", 30, 39), ("food crisis", 41, 52), ("crisis", 46, 52), ("crisis", 53, 59)}


def test_models_fail_for_a_document_only(spark):
    def load():
        def find(texts):
            if "bad" in texts[0]:
                raise RuntimeError("no")
            return [[{"label": "event", "text": texts[0], "confidence": 0.9, "start": 0, "end": 1}, {"label": "event", "text": "low", "confidence": 0.1, "start": 0, "end": 1}]]

        return find

    docs = spark.createDataFrame([(1, "good"), (2, "bad")], "doc_id long, text string")
    got = {(r.doc_id, r.label) for r in mentions.model_mentions(docs, load, 0.3).collect()}
    assert got == {(1, "event"), (2, "error")}
    clusters = mentions.resolve_coreferences(docs, lambda: lambda t: [[(0, 2), (2, 3)], [(1, 2)]] if t == "good" else 1 / 0).collect()
    assert [(r.doc_id, r.m_start, r.a_start, r.a_text) for r in clusters] == [(1, 2, 0, "go")]


def test_clusters_table(spark):
    c = spark.createDataFrame([(1, ["Avon", "it", "there"], [[0, 4], [10, 12], [20, 25]]), (1, ["x"], [[1, 2]])], "doc_id long, strings array<string>, offsets array<array<int>>")
    assert sorted((r.m_start, r.a_end, r.a_text) for r in mentions.coref_pairs(c).collect()) == [(10, 4, "Avon"), (20, 4, "Avon")]


def test_graph(spark):
    m = spark.createDataFrame([(1, 0, "event", "War", 0, 3), (1, 1, "location", "Avon", 5, 9), (1, 2, "date", "war", 11, 14)], "doc_id long, ord int, label string, text string, start int, end int")
    ids = graph.entity_ids(m)
    assert [(r.id, r.label) for r in ids.orderBy("id").collect()] == [("e1", "EVENT"), ("e2", "LOCATION")]
    edges = spark.createDataFrame([(1, "WAR", "avon", "occurred_in"), (1, "war", "nowhere", "occurred_in")], "doc_id long, head string, tail string, relation_type string")
    assert [tuple(r) for r in graph.relations(ids, edges).collect()] == [(1, "e1", "e2", "occurred_in")]
    c = spark.createDataFrame([(1, 0, ""), (1, 1, "sport"), (1, 2, "world")], "doc_id long, chunk_idx int, class string")
    assert graph.first_class(c).first()["class"] == "sport"


def test_stream(spark, tmp_path):
    docs = spark.createDataFrame([(1, "A famine and a drought in Avon.")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "in"))
    lex = {"location": ["avon"], "food crisis": ["famine"], "weather shocks": ["drought"]}
    config = Config(gazetteer=lex, linker="nearest")
    q = extract_stream(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in")), config, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).select(F.col("event_text"), F.col("location_text")).collect()
    assert {tuple(r) for r in got} == {("famine", "Avon"), ("drought", "Avon")}
