"""Exact, SimHash and embedding deduplication, and connected components, against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash

from spanlink.llm.embedding_dedup import assign, make_tables, near_duplicates, unit
from spanlink.llm.exact_dedup import exact_dedup
from spanlink.llm.graph import components
from spanlink.llm.queries import ORACLE_SQL, QUERIES
from spanlink.llm.simhash import fingerprint, grid_points, links, simhash_groups
from tests.llm.data import BASE, docs, union_find
from tests.oracle import same


def test_exact_equals_sql(spark, sf):
    same(spark, QUERIES, ORACLE_SQL, "op4_exact_dedup", sf)


@pytest.mark.parametrize("block", [1, 3, 1 << 14])
def test_exact_equals_brute_force(spark, block):
    rnd = random.Random(2)
    texts = [None, "", " \n", "\x1c", "é e", "ée", "x" * 3000, " x" * 3000, *("".join(rnd.choice("ab \t") for _ in range(rnd.randint(0, 9))) for _ in range(120))]
    ids = [None if i % 17 == 0 else i % 60 for i in range(len(texts))]
    got = exact_dedup(docs(spark, texts, ids=ids), block).collect()
    assert len(got) == len(texts)
    groups = {}
    for i, t in zip(ids, texts, strict=True):
        norm = "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(hashlib.sha256(norm.encode()).hexdigest(), []).append((-len(t or ""), i is None, i or 0))
    for r in got:
        g = groups[r.text_sha256]
        best = min(g)
        assert r.group_size == len(g) and r.keep_id == (None if best[1] else best[2])
    assert sum(r.kept for r in got) == len(groups)


def test_exact_of_nothing(spark):
    assert exact_dedup(docs(spark, [])).count() == 0


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def test_simhash_equals_brute_force(spark):
    rnd = random.Random(9)
    texts = [None, "", "\t", "One", "one", "one two", (BASE + "end ") * 900]
    for _ in range(12):
        words = [rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(rnd.randint(60, 500))]
        for _ in range(10):
            copy = list(words)
            if rnd.random() < 0.8:
                copy[rnd.randrange(len(copy))] = "zz"
            texts.append(" ".join(copy))
    ids = [i // 2 if i < 4 else i for i in range(len(texts))]
    got = simhash_groups(docs(spark, texts, ids=ids)).collect()
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    distinct = set(fps.values())
    root = union_find(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2])
    assert len(set(root.values())) < len(distinct)  # there are links between different fingerprints
    first = {}
    for i, f in fps.items():
        first[root[f]] = min(first.get(root[f], ids[i]), ids[i])
    assert sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == sorted((ids[i], f, first[root[f]]) for i, f in fps.items())
    assert sum(r.kept for r in got) == len(first)


def test_simhash_counts_in_chunks(monkeypatch):
    words = [bytes([97 + i % 23]) * (i % 5 + 1) for i in range(500)]
    whole = fingerprint(words, 3)
    monkeypatch.setattr("spanlink.llm.simhash.CHUNK", 7)
    assert fingerprint(words, 3) == whole == brute_fingerprint(b" ".join(words).decode())


def test_links_of_planted_fingerprints(spark):
    rnd = random.Random(1)
    nodes = {0, (1 << 64) - 1}
    for _ in range(40):
        x = rnd.getrandbits(64)
        nodes.add(x)
        for _ in range(rnd.randint(0, 6)):
            y = x
            for b in rnd.sample(range(64), rnd.randint(1, 3)):
                y ^= 1 << b
            nodes.add(y)
            x = y if rnd.random() < 0.5 else x
    signed = [x - (1 << 64) if x >> 63 else x for x in nodes]
    got = components(links(spark.createDataFrame([(x,) for x in signed], "fp long")))
    found = {r.node: r.root for r in got.collect()}
    want = union_find(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2])
    assert {x: found.get(x, x) for x in signed} == want


def test_grid_points_of_corners(spark):
    for point, n in ((0, 17), (0x4444444444444444, 17), (0x2222222222222222, 33)):
        assert len(set(spark.createDataFrame([(point,)], "p long").select(grid_points("p").alias("g")).first().g)) == n


def test_simhash_of_nothing(spark):
    assert simhash_groups(docs(spark, [])).count() == 0


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 260)] + [(400, x) for x in range(401, 700)] + [(rnd.randint(1000, 1200), rnd.randint(1000, 1200)) for _ in range(130)] + [(5, 5), (None, 3), (7, 8), (8, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == union_find({x for e in real for x in e}, real)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_vectors(rows, threshold):
    ok = [v is not None and label is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    out = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i], rows[j]
            if ok[i] and ok[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                    out[i].add(j)
                    out[j].add(i)
    return out


@pytest.mark.parametrize("block", [4, 1024])
def test_embeddings_equal_brute_force(spark, block):
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(40):
        v = rnd.normal(size=8)
        for _ in range(rnd.integers(1, 9)):
            rows.append([len(rows), (v + rnd.normal(size=8) * 0.07).tolist(), int(i % 3)])
            if rnd.random() < 0.3:
                rows.append([len(rows), rows[-1][1], int(i % 3)])
    odd = [(None, 1), ([], 1), ([0.0] * 8, 1), ([float("nan")] * 8, 1), ([float("inf")] * 8, 1), ([None] * 8, 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([1.0] * 8, None), ([1.0] * 8, None)]
    rows += [[len(rows) + k, v, label] for k, (v, label) in enumerate(odd)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, label int, n_links int").repartition(3)
    got = {r.vec_id: r for r in near_duplicates(df, 0.98, block).collect()}
    want = brute_vectors(rows, 0.98)
    root = union_find(want.keys(), [(a, b) for a in want for b in want[a]])
    assert len(got) == len(rows) and sum(map(len, want.values())) > 50
    for i in want:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(want[i]), root[i], root[i] == i)


def check_embeddings(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, 0.98, **how).collect()}
    v = np.array([r[1] for r in rows], np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (v @ v.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    root = union_find(range(len(rows)), np.argwhere(np.triu(linked)).tolist())
    assert got == {i: (int(linked[i].sum()), root[i]) for i in range(len(rows))}
    return linked


@pytest.mark.parametrize("per_cell,block", [(20, 64), (1, 4096)])
def test_embeddings_in_many_cells(spark, per_cell, block):
    """Chains of copies, a large group, vectors between centroids and unrelated ones, in 2 to hundreds of cells."""
    rnd = np.random.default_rng(7)
    rows = []
    for i in range(60):
        v = rnd.normal(size=16)
        for _ in range(400 if i == 0 else 12):
            rows.append((len(rows), v.tolist(), 0 if i == 0 else i % 2))
            v = (rows[-1][1] if i % 3 else rows[-1][1] / np.linalg.norm(rows[-1][1])) + rnd.normal(size=16) * (0.01 if i == 0 else 0.05)
    rows += [(len(rows) + i, rnd.normal(size=16).tolist(), i % 2) for i in range(500)]
    assert check_embeddings(spark, rows, per_cell=per_cell, block=block).sum() > 5000


@pytest.mark.parametrize("directions", [1, 3])
def test_scaled_copies_and_equal_centroids(spark, directions):
    """All vectors are multiples of few directions, so that all centroids of a direction are equal up to rounding."""
    rnd = np.random.default_rng(directions)
    base = rnd.normal(size=(directions, 8))
    rows = [(i, (base[i % directions] * rnd.uniform(0.01, 1000)).tolist(), 1) for i in range(1000)]
    assert check_embeddings(spark, rows, per_cell=50, block=256).sum() == sum(n * (n - 1) for n in np.bincount(np.arange(1000) % directions))


def test_extreme_lengths_and_repeated_rows(spark):
    rows = [(i, [1e30, 1e-30 * i, 1.0], 1) for i in range(4)] + [(4 + i, [1e-40, 2e-40, 0.0], 1) for i in range(3)]
    df = spark.createDataFrame(rows + rows + [(None, rows[0][1], 1)], "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id) for r in near_duplicates(df).collect())
    assert got == sorted([(i, 8, 0) for i in range(4)] * 2 + [(4 + i, 5, 4) for i in range(3)] * 2 + [(-1, 8, 0)])


def test_embeddings_equal_sql(spark, sf):
    same(spark, QUERIES, ORACLE_SQL, "op10_embedding_dedup", sf)


def test_miss_rate_of_tables():
    """Pairs at the threshold share a cell of some table; tables grow slowly with the rows."""
    rnd = np.random.default_rng(1)
    sample = unit(rnd.normal(size=(4000, 64)))
    sizes = [len(make_tables(sample, rows, 0.98)) for rows in (10**3, 10**5, 10**7)]
    assert max(sizes) <= 3 * min(sizes)
    x = unit(rnd.normal(size=(20000, 64)))
    d = rnd.normal(size=x.shape)
    d = unit(d - (d * x).sum(1, keepdims=True) * x)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * d
    tables = make_tables(sample, 10**5, 0.98)
    assert (assign(x, tables) == assign(y, tables)).any(1).all()


def test_embeddings_of_nothing(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
