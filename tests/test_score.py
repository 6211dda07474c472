import pytest
from pyspark.sql import functions as F

from spanlink.functions.metrics import efficiency, scores
from spanlink.operators import match, report, score

# Counts (tp, fp, fn) and the published scores at four places, rounded half to even.
PUBLISHED = [
    ((21, 0, 12), (1.0, 0.6364, 0.7778, 0.8974, 0.6863, 0.6364)),
    ((32, 1, 1), (0.9697, 0.9697, 0.9697, 0.9697, 0.9697, 0.9412)),
    ((27, 0, 6), (1.0, 0.8182, 0.9, 0.9574, 0.8491, 0.8182)),
    ((31, 6, 2), (0.8378, 0.9394, 0.8857, 0.8564, 0.9172, 0.7949)),
    ((21, 7, 4), (0.75, 0.84, 0.7925, 0.7664, 0.8203, 0.6562)),
    ((461, 455, 210), (0.5033, 0.687, 0.581, None, None, None)),
    ((390, 269, 281), (0.5918, 0.5812, 0.5865, None, None, None)),
    ((9, 58, 131), (0.1343, 0.0643, 0.087, None, None, None)),
    ((0, 0, 0), (0.0, 0.0, 0.0, 0.0, 0.0, 0.0)),
]


def test_scores(spark):
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(PUBLISHED)], "i int, tp long, fp long, fn long").withColumns({n: F.bround(c, 4) for n, c in scores().items()})
    for r in df.collect():
        for n, want in zip(("precision", "recall", "f1", "f05", "f2", "jaccard"), PUBLISHED[r.i][1], strict=True):
            assert want is None or r[n] == pytest.approx(want, abs=1e-9), (r.i, n)


def test_macro_counts_empty_documents_as_zero(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    pred = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, key string")
    gold = spark.createDataFrame([(1, "a"), (2, "c")], "doc_id long, key string")
    per = score.per_document(pred, gold, ["doc_id", "key"], docs)
    assert score.macro(per).first().macro_f1 == pytest.approx(1 / 3)
    assert score.micro(per).first()["tp"] == 1


def test_failed_documents(spark):
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    pred = gold = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, key string")
    failed = spark.createDataFrame([(2,)], "doc_id long")
    empty = score.micro(score.per_document(pred, gold, ["doc_id", "key"], docs, failed)).first()
    skipped = score.micro(score.per_document(pred, gold, ["doc_id", "key"], docs, failed, "skip")).first()
    assert (empty.tp, empty.fn) == (1, 1) and (skipped.tp, skipped.fn) == (1, 0)
    with pytest.raises(ValueError):
        score.per_document(pred, gold, ["doc_id", "key"], docs, failed, "other")


def test_errors_tell_what_was_linked(spark):
    pred = spark.createDataFrame([(1, "war", "b"), (1, "war", "c")], "doc_id long, event string, location string")
    gold = spark.createDataFrame([(1, "war", "a")], "doc_id long, event string, location string")
    got = {(r.location, r.error, r.instead) for r in score.missed_and_wrong(pred, gold).collect()}
    assert got == {("a", "missed", "b"), ("b", "wrong", "a"), ("c", "wrong", "a")}


def greedy(pairs):
    out, p, g = [], set(), set()
    for s, a, b in sorted(pairs, key=lambda x: (-x[0], x[1], x[2])):
        if a not in p and b not in g:
            out.append((a, b))
            p.add(a)
            g.add(b)
    return sorted(out)


def test_one_to_one_equals_taking_the_best_first(spark):
    import random

    rnd = random.Random(4)
    docs = {d: [(rnd.randint(1, 6) / 6, a, b) for a in range(6) for b in range(7) if rnd.random() < 0.6] for d in range(12)}
    df = spark.createDataFrame([(d, a, b, s) for d, ps in docs.items() for s, a, b in ps], "doc_id long, p long, g long, score double")
    got = {d: [] for d in docs}
    for r in match.one_to_one(df, ["doc_id"]).collect():
        got[r.doc_id].append((r.p, r.g))
    assert {d: sorted(x) for d, x in got.items()} == {d: greedy(x) for d, x in docs.items()}


def test_one_to_one_of_a_long_chain(spark):
    pairs = [(1, p, g, 1.0) for p in range(1100) for g in (p - 1, p) if g >= 0]  # only one pair is the best of both its sides at a time
    got = match.one_to_one(spark.createDataFrame(pairs, "doc_id long, p long, g long, score double"), ["doc_id"])
    assert sorted((r.p, r.g) for r in got.collect()) == [(p, p) for p in range(1100)]


def test_equal_texts_match_by_rank(spark):
    p = spark.createDataFrame([(1, i, "city") for i in range(1500)], "doc_id long, id long, text string")
    g = spark.createDataFrame([(1, 5000 + i, "City") for i in range(1400)], "doc_id long, id long, text string")
    assert sorted((r.p, r.g) for r in match.match(p, g, "relaxed", ["doc_id"]).collect()) == [(i, 5000 + i) for i in range(1400)]


def test_modes(spark):
    p = spark.createDataFrame([(1, 1, "the flood", [1.0, 0.0]), (1, 2, "war", [0.0, 1.0])], "doc_id long, id long, text string, embedding array<double>")
    g = spark.createDataFrame([(1, 7, "Flood", [0.9, 0.1]), (1, 8, "WAR", [0.0, 0.0])], "doc_id long, id long, text string, embedding array<double>")
    got = {m: {(r.p, r.g) for r in match.match(p, g, m, ["doc_id"]).collect()} for m in match.MODES}
    assert got == {"strict": {(2, 8)}, "relaxed": {(1, 7), (2, 8)}, "semantic": {(1, 7)}}


def test_report(spark):
    rows = [("a", 1, 2.0, False, 3, 1, 1, 2, 1, 1), ("a", 2, 4.0, True, 9, 9, 9, 9, 9, 9), ("b", 1, 1.0, False, 1, 1, 1, 0, 1, 1)]
    runs = spark.createDataFrame(rows, "model string, doc_id long, seconds double, failed boolean, ent_tp long, ent_fp long, ent_fn long, pair_tp long, pair_fp long, pair_fn long")
    s = report.run_summary(runs)
    a = s.filter("model = 'a'").first()
    assert (a.evaluated, a.errors, a.avg_s) == (1, 1, 2.0) and a.efficiency == pytest.approx(round((2 / 3) / 2, 4))
    c = report.champions(s).first()
    assert (c.best_entities, c.fastest) == ("a", "b")
    assert "| 1 | a |" in report.markdown(s, "Runs")


def test_efficiency_rounds_half_to_even(spark):
    assert spark.range(1).select(efficiency(F.lit(0.0625), F.lit(2.0)).alias("x")).first().x == 0.0312
