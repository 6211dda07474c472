"""fuzzy_match and the semantic mode against taking the best of all pairs first."""

import random
import re

import numpy as np

from spanlink.operators import match, spans
from spanlink.plans.queries import CONFIG, QUERIES, _mentions


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def relaxed(a, b):
    a, b = a.lower(), b.lower()
    x, y = set(re.findall(r"\w+", a)), set(re.findall(r"\w+", b))
    return max(len(x & y) / len(x | y), float(a in b or b in a), 1 - edit(a, b) / max(len(a), len(b)))


def greedy(pairs):
    out, used = set(), set()
    for _, p, g in sorted(pairs, key=lambda x: (-x[0], x[1], x[2])):
        if not {("p", p), ("g", g)} & used:
            out.add((p, g))
            used |= {("p", p), ("g", g)}
    return out


def test_fuzzy_match_equals_all_pairs_of_an_article(spark, tmp_path):
    rnd = random.Random(6)
    terms = ["from", "by", "le", "für", "que", "the of", "of the", "for", "den", "un", "was", "de la", "x.", "city", "y!"]
    rows = [(d, " ".join(rnd.choice(terms) for _ in range(60))) for d in range(12)] + [(50, "It came from x. It was for y.")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {}
    for r in QUERIES["fuzzy_match"](spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, set()).add((r.p, r.g))
    m = _mentions(spark, str(tmp_path)).cache()
    pred = [r for r in spans.greedy_dedup(m, CONFIG).collect() if r.label == "location"]
    gold = [r for r in m.collect() if r.label != "location" or r.start % 2 == 0]
    assert pred and {r.ord for r in pred if r.doc_id == 50} and got
    want = {}
    for d in {r.doc_id for r in pred}:
        pairs = [(relaxed(p.text, g.text), p.ord, g.ord) for p in pred if p.doc_id == d for g in gold if g.doc_id == d]
        if found := greedy([x for x in pairs if x[0] >= 0.5]):
            want[d] = found
    assert got == want


def test_semantic_mode_equals_all_pairs(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(size=3)], i % 4) for i in range(120)]
    e = spark.createDataFrame([(i, v, k) for i, v, k in rows], "id long, embedding array<double>, label int")
    got = {(r.p, r.g) for r in match.match(e.filter("id % 10 = 0"), e.filter("id % 10 != 0"), "semantic", ["label"]).collect()}
    want = set()
    for label in range(4):
        v = {i: np.array(e) / np.linalg.norm(e) for i, e, k in rows if k == label}
        want |= greedy([(c, p, g) for p in v for g in v if p % 10 == 0 and g % 10 and (c := float(v[p] @ v[g])) >= 0.7])
    assert got == want and want
