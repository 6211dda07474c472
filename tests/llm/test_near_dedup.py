"""Near-duplicates of the pipeline against all pairs."""

import random
import time

import pytest

import corpus_pipeline
from spanlink.llm import near_dedup
from spanlink.llm.near_dedup import BITS, _signatures, links, near_groups, prefix_pairs
from spanlink.llm.simhash import fingerprint, parts, shared_strings
from tests.llm.data import docs, union_find


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similarity(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def edited(rnd, words, n):
    words = list(words)
    for at in rnd.sample(range(len(words)), n):
        words[at] = "zz%d" % rnd.randrange(10**6)
    return words


@pytest.fixture(scope="module")
def texts():
    """Texts of 120 to 400 words, copies of copies with 1 to 8 other words, a large group of copies of one text, and short ones."""
    rnd = random.Random(8)
    out = [None, "", " \t", "One two", "one  TWO", "one two three"]
    for k in range(25):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(rnd.randint(120, 400))]
        for _ in range(150 if k == 0 else 6):
            copy = edited(rnd, words, rnd.randint(1, 8))
            out.append(" ".join(copy).upper() if rnd.random() < 0.3 else " ".join(copy))
            words = copy if k % 2 else words
    return out


def wanted(texts):
    pairs = [(a, b) for b in range(len(texts)) for a in range(b) if similarity(texts[a], texts[b]) >= 0.8]
    return union_find(range(len(texts)), pairs)


def test_groups_equal_all_pairs(spark, texts):
    got = near_groups(docs(spark, texts)).collect()
    want = wanted(texts)
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(texts)
    assert {r.doc_id for r in got if r.kept} == set(want.values())


def test_altered_copies_cost_no_pairs(spark):
    """A large group of copies of one text, most of which are too far apart for a link."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(150)]
    all_ = [" ".join(edited(rnd, words, rnd.choice([0, 1, 2, 3, 5, 8, 12, 16]))) for _ in range(500)]
    got = {r.doc_id: r.component_id for r in near_groups(docs(spark, all_)).collect()}
    assert got == wanted(all_)


@pytest.mark.parametrize("bits", [2, 5])
def test_shared_strings_equal_all_pairs(spark, bits):
    """Fingerprints at distances around those of the join, equal ones, and the ones whose highest bits are set."""
    rnd = random.Random(3)
    fps = [0, 1, (1 << 64) - 1, 1 << 63]
    for _ in range(40):
        base = rnd.getrandbits(64)
        fps += [base, base] + [base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 8))) for _ in range(4)]
    rows = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    tried = set()
    for low, high in parts(bits):
        of = {}
        for r in shared_strings(rows, low, high).collect():
            of.setdefault(r.string, []).append(r.node)
        got = {(a, b) for v in of.values() for a in v for b in v if a < b}
        mask = (1 << 4 * high) - (1 << 4 * low)
        assert got == {(a, b) for b in range(len(fps)) for a in range(b) if ((fps[a] ^ fps[b]) & mask).bit_count() <= 2}
        tried |= got
    assert {(a, b) for b in range(len(fps)) for a in range(b) if (fps[a] ^ fps[b]).bit_count() <= bits} <= tried


def test_simhash_chooses_candidates(spark):
    """Without any MinHash band, texts whose fingerprints are near each other are linked if their sets are similar, and only then."""
    rnd = random.Random(6)
    all_ = []
    for _ in range(12):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(rnd.randint(200, 400))]
        all_ += [" ".join(words), *[" ".join(edited(rnd, words, rnd.randint(1, 12))) for _ in range(4)]]
    texts = spark.createDataFrame(list(enumerate(all_)), "rid long, text string")
    made = _signatures(texts.selectExpr("rid", "rid as doc_id", "text"), 5)
    nodes = made.selectExpr("rid as node", "rid", "n", "fp", "cast(array() as array<bigint>) as bands")
    top = union_find(range(len(all_)), [(r.u, r.v) for r in links(nodes, texts, 5, 0.8).collect()])
    fp = {r.node: r.fp % (1 << 64) for r in nodes.collect()}
    assert fp[0] == fingerprint(all_[0].encode().split(), 5)  # operator 5's, as no shingle is repeated
    pairs = [(a, b) for b in range(len(all_)) for a in range(b)]
    near = [(a, b) for a, b in pairs if (fp[a] ^ fp[b]).bit_count() <= BITS and similarity(all_[a], all_[b]) >= 0.8]
    assert len(near) > 10 and all(top[a] == top[b] for a, b in near)
    full = wanted(all_)
    assert all(full[a] == full[b] for a, b in pairs if top[a] == top[b])


@pytest.mark.parametrize("least", [0.5, 0.8, 0.95])
def test_prefix_pairs_lose_none(spark, least):
    """Random small sets, whose sizes and overlaps lie on the borders of the filter."""
    rnd = random.Random(11)
    sets = [sorted(rnd.sample(range(14), rnd.randint(1, 12))) for _ in range(250)]
    nodes = spark.createDataFrame([(i, len(s), i % 200) for i, s in enumerate(sets)], "node long, n int, root long")
    got = {(r.u, r.v) for r in prefix_pairs(nodes, spark.createDataFrame(list(enumerate(sets)), "node long, shingles array<bigint>"), least).collect()}
    similar = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) >= least
    assert {(i, j) for i in range(250) for j in range(i) if i % 200 != j % 200 and similar(sets[i], sets[j])} <= got


def test_stage_keeps_one_of_each_group(spark, texts, tmp_path):
    docs(spark, texts).write.parquet(str(tmp_path / "d"))
    got = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "d")), "")
    assert {r.doc_id for r in got.collect()} == set(wanted(texts).values())


def test_null_ids_and_nothing(spark):
    got = near_groups(docs(spark, ["a b", "A b", "a b", "c"], ids=[None, 5, 3, None])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [("3", "3", True), ("5", "3", False), ("None", "3", False), ("None", "None", True)]
    assert near_groups(docs(spark, [])).count() == 0


def test_shuffle_files_go_at_once(spark, texts, tmp_path):
    """None is left when the groups are found, though the driver has collected no garbage; the setting is as before, and rows can be read twice."""
    docs(spark, texts).write.parquet(str(tmp_path / "d"))
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {n.rpartition("/")[2] for n in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in n}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_to, before = spark.conf.get(key, None), shuffled()
    out = near_groups(spark.read.parquet(str(tmp_path / "d")))
    for _ in range(50):  # files are deleted in the background
        if not (left := shuffled() - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(key, None) == set_to
    assert sorted(out.collect()) == sorted(out.collect())


def test_chance_partners_hold_little(spark, monkeypatch):
    """Buckets of 2 to 4 unrelated texts: sets are held only where sizes allow the similarity, and none is left for the prefix filter."""
    rnd = random.Random(7)
    size = lambda i: 100 if i < 60 else 100 * 2 ** (i % 4)  # noqa: E731  no bucket of the latter has two of a size
    all_ = [" ".join("%x" % rnd.randrange(10**9) for _ in range(size(i))) for i in range(180)]
    all_[59] = all_[58] + " end"
    texts = spark.createDataFrame(list(enumerate(all_)), "rid long, text string")
    made = _signatures(texts.selectExpr("rid", "rid as doc_id", "text"), 5)
    nodes = made.selectExpr("rid as node", "rid", "n", "fp", "array(if(rid < 60, floor(rid / 2), 100 + floor(rid / 4))) as bands")
    seen = {}
    for name in ("_sets", "prefix_pairs"):
        monkeypatch.setattr(near_dedup, name, lambda rows, *a, name=name, f=getattr(near_dedup, name): (seen.update({name: rows.count()}), f(rows, *a))[1])
    assert [(r.u, r.v) for r in links(nodes, texts, 5, 0.8).collect()] == [(59, 58)]
    assert seen == {"_sets": 60, "prefix_pairs": 0}
