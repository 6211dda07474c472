"""Mixing, quality and sharding."""

import math
import random
import zlib

import duckdb
import pytest

from spanlink.llm.mixing import mix, targets
from spanlink.llm.queries import QUERIES
from spanlink.llm.quality import resample
from spanlink.llm.sharding import shard
from tests.llm.data import BASE, docs


def filled(sizes, weights, share, most):
    """Targets by sharing out, capping, and sharing out again what that leaves."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, free = share * sum(sizes.values()), {}, set(names)
    while free:
        total = sum(w[s] for s in free)
        now = {s: left * w[s] / total for s in free}
        over = {s for s in free if now[s] > most * sizes[s]}
        if not over:
            out.update(now)
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_targets(spark):
    rnd = random.Random(2)
    for n in (1, 2, 3, 9, 30):
        sizes = {(None if i == 0 else chr(60 + rnd.randint(0, 200)) + str(i)): rnd.choice([0, 1, 5, 100, 10**6]) for i in range(n)}
        got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), [5, 2, 1], 1.5, 2.0).collect()}
        want = filled(sizes, [5, 2, 1], 1.5, 2.0)
        assert got.keys() == want.keys()
        assert all(got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9) for s in want)


def test_mix(spark):
    rnd = random.Random(7)
    texts = [None, "", "  ", "one"] + [" ".join(["w"] * rnd.randint(1, 60)) for _ in range(1500)]
    sources = [None if i % 7 == 0 else f"s{min(i % 5, 2)}" for i in range(len(texts))]
    d = docs(spark, texts, sources, ids=[i // 2 for i in range(len(texts))])
    got = mix(d).collect()
    assert len(got) == len(texts)
    for source in set(sources):
        rows = [r for r in got if r.source == source]
        assert sum(r.size for r in rows) == rows[0].source_size
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 60
        assert all(r.taken == r.size * r.copies and r.copies in (0, 1, 2) for r in rows)
    key = lambda r: (r.doc_id, r.source or "", r.size, r.copies)
    assert sorted(map(key, mix(d.repartition(5)).collect())) == sorted(map(key, got))
    assert mix(docs(spark, [])).count() == 0


def test_short_documents_have_higher_odds(spark):
    d = docs(spark, ["w " * 20000] * 150 + ["w " * 10] * 1500, ["a"] * 1650)
    got = mix(d, share=1.3).collect()
    rate = lambda rows: sum(r.copies - 1 for r in rows) / len(rows)
    assert rate([r for r in got if r.size == 10]) > rate([r for r in got if r.size == 20000]) + 0.1


def test_inclusion_is_calibrated(spark):
    """Documents of each length are taken as often as odds that give the target in expectation say."""
    lengths = {10: 6000, 300: 6000, 3000: 6000}
    texts = [t for n, times in lengths.items() for t in ["w " * n] * times]
    d = docs(spark, texts, ["a"] * len(texts))
    share = 1.3
    got = mix(d, share=share).collect()
    rest = (share - 1) * sum(n * times for n, times in lengths.items())
    odds = {n: 2 ** (-math.floor(4 * math.log2(1 + n / 1000)) / 16) for n in lengths}
    low, high = -30.0, 30.0
    for _ in range(100):
        c = (low + high) / 2
        p = {n: odds[n] * math.exp(c) / (1 + odds[n] * math.exp(c)) for n in lengths}
        low, high = (c, high) if sum(n * times * p[n] for n, times in lengths.items()) < rest else (low, c)
    for n, times in lengths.items():
        rate = sum(r.copies - 1 for r in got if r["size"] == n) / times
        assert abs(rate - p[n]) < 4 * (p[n] * (1 - p[n]) / times) ** 0.5


def test_mix_is_the_order_of_ranks(spark):
    """The levels of bins take what one ordering of all ranks takes."""
    rnd = random.Random(3)
    d = docs(spark, [" ".join(["w"] * rnd.randint(0, 40)) for _ in range(3000)], [f"s{i % 3}" for i in range(3000)])
    assert sorted((r.doc_id, r.copies) for r in mix(d, bins=2).collect()) == sorted((r.doc_id, r.copies) for r in mix(d, bins=1 << 20).collect())


def test_word_counts(spark, sf):
    got = {r.doc_id: r["size"] for r in QUERIES["op7_mixing"](spark, sf).collect()}
    want = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert got == {i: len((t or "").encode().split()) for i, t in want}


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    got = resample(d, seen).join(held, "doc_id").select("kept", "quality").collect()
    right = sum(r.kept == (r.quality > 0) for r in got) / len(got)
    good = [r.kept for r in got if r.quality > 0]
    assert right > 0.95 and sum(good) / len(good) > 0.98


def test_quality_of_odd_rows(spark):
    texts = [None, "", BASE * 400, *[BASE + f" number {i}" for i in range(60)], *["%%% $$$ ### " * 20 + str(i) for i in range(20)], BASE + " number 5"]
    d = docs(spark, texts)
    labels = spark.createDataFrame([(i, 1) for i in range(3, 40)] + [(i, 0) for i in range(64, 75)] + [(None, 1), (5, None), (5, 0), (9999, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in resample(d, labels).collect()}
    assert len(got) == len(texts) and got[0].weight == got[1].weight == 0
    assert all(got[i].kept for i in range(3, 63)) and not any(got[i].kept for i in range(66, 83))
    assert got[2].kept
    again = {r.doc_id: r.kept for r in resample(d.repartition(5), labels).collect()}
    assert again == {i: r.kept for i, r in got.items()}
    assert all(r.kept for r in resample(d, labels.limit(0)).collect())
    assert resample(docs(spark, []), labels).count() == 0


def test_sample_is_the_largest_sums(spark, monkeypatch):
    """Divided bins keep what one ordering of all sums keeps."""
    from spanlink.llm import quality

    texts = [BASE + f" number {i % 300}" for i in range(600)] + ["%%% $$$ ### " * 20 + str(i) for i in range(200)]
    labels = spark.createDataFrame([(i, 1) for i in range(0, 600, 2)] + [(i, 0) for i in range(600, 800, 2)], "doc_id long, quality int")
    found = []
    for levels in (1, 3):
        monkeypatch.setattr(quality, "LEVELS", levels)
        found.append({r.doc_id: r.kept for r in resample(docs(spark, texts), labels).collect()})
    assert found[0] == found[1] and any(found[0].values()) and not all(found[0].values())


def test_sharding(spark):
    texts = [None, "", "é", "x" * 100000] + [f"text {i % 50}" for i in range(3000)]
    ids = [None if i % 11 == 0 else i % 700 for i in range(len(texts))]
    got = shard(docs(spark, texts, ids=ids)).collect()
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in got) == sorted((i or -1 if i else -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True))
    of = {}
    for r in got:
        assert r.law == "key" and of.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.grown_shard in (r.shard, 40)
    for s in range(40):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    moved = sum(a != b for a, b in of.values()) / len(of)
    assert 0.005 < moved < 0.05
    assert shard(docs(spark, [])).count() == 0


def test_weighted_shards(spark):
    d = docs(spark, ["x"] * 6000)
    got = shard(d, 3, weights=[1, 2, 3]).groupBy("shard").count().collect()
    counts = {r.shard: r["count"] / 6000 for r in got}
    assert all(counts[i] == pytest.approx((i + 1) / 6, abs=0.03) for i in range(3))


def test_native_plans(spark, sf):
    for name in ("op7_mixing", "op9_sharding"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
