import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spanlink.llm.common import shared_dir
from spanlink.llm.mixing import mix
from spanlink.llm.queries import QUERIES
from tests.llm.data import BASE, docs


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A corpus of clean, junk, copied and nearly copied documents."""
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    clean = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(80, 250))) for _ in range(150)]
    junk = [" ".join(rnd.choice(vocabulary) + rnd.choice(["%%%", "$$$", "###"]) for _ in range(80)) for _ in range(40)]
    copies = [t.replace(" ", "  ", 3) for t in clean[:20]]
    near = [t.upper() for t in clean[20:40]]  # same words in another case have the same fingerprint
    texts = clean + junk + copies + near + [None, ""]
    path = str(tmp_path_factory.mktemp("sf"))
    docs(spark, texts).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(40, 110)] + [(i, 0, 0) for i in range(150, 175)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    d = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = d.columns
        stage(spark, d, folder).write.parquet(str(tmp_path / str(k)))
        d = spark.read.parquet(str(tmp_path / str(k)))
        kept[k] = [r.doc_id for r in d.select("doc_id").collect()]
        if k < len(corpus_pipeline.STAGES) - 1:
            assert d.columns == columns, name
    quality, exact, near, mixed, coded = kept.values()
    assert set(range(150)) <= set(quality) and not set(quality) & set(range(150, 190))
    assert len(exact) == len(set(exact))
    assert not set(range(20)) & set(exact) and set(range(190, 210)) <= set(exact)  # the longer original stays
    assert set(range(20, 150)) <= set(near) and not set(near) & set(range(210, 230))
    assert set(mixed) <= set(near) and max(map(mixed.count, set(mixed))) <= 2
    assert sorted(coded) == sorted(mixed)
    source = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in d.collect():
        assert r.text == source[r.doc_id] and r.n_tokens == len(r.ids) // 4


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    again = corpus_pipeline.run(spark, folder).collect()
    assert rows and sorted((r.doc_id, r.n_tokens) for r in rows) == sorted((r.doc_id, r.n_tokens) for r in again)


def test_empty_documents_table(spark, tmp_path):
    docs(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_repeated_rows_and_null_ids(spark, tmp_path):
    docs(spark, [BASE, BASE, None, None, BASE + "x"], ids=[1, 1, None, None, None]).write.parquet(str(tmp_path / "d"))
    d = spark.read.parquet(str(tmp_path / "d"))
    assert sorted((r.text or "") for r in corpus_pipeline.drop_copies(spark, d, "").collect()) == sorted([BASE, "", BASE + "x"])


def test_rows_stay_apart_when_splits_change(spark, tmp_path):
    """The second read of a stage's input splits its files otherwise, and columns of docs have the names of the stages' own."""
    rows = [(i, f"word{i % 40} " * 30 + str(i % 50), f"s{i % 3}", 99 - i, 7, 1) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, __rid long, __copies int, `__odd.name` int").repartition(37).write.parquet(str(tmp_path / "d"))
    spark.read.parquet(f"{tmp_path}/d").select("doc_id", F.lit(1).alias("quality")).limit(0).write.parquet(str(tmp_path / "labels.parquet"))

    def read(stage):
        try:
            spark.conf.set("spark.sql.files.minPartitionNum", "3")
            out = stage(spark, spark.read.parquet(f"{tmp_path}/d"), str(tmp_path))
            spark.conf.set("spark.sql.files.minPartitionNum", "29")
            spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
            return [tuple(r) for r in out.collect()]
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    assert sorted(read(corpus_pipeline.quality_classifier)) == sorted(rows)
    assert sorted(read(corpus_pipeline.drop_copies)) == sorted({r[1]: r for r in reversed(rows)}.values())
    near = read(corpus_pipeline.drop_near_copies)
    assert set(near) <= set(rows) and len({r[1].split()[0] for r in near}) == 40
    mixed = read(corpus_pipeline.mix_sources)
    want = {r.doc_id: r.copies for r in mix(spark.createDataFrame(rows, "doc_id long, text string, source string, a long, b int, c int")).collect()}
    assert set(mixed) <= set(rows) and Counter(r[0] for r in mixed) == Counter({i: n for i, n in want.items() if n})


def test_run_leaves_its_rows_only(spark, folder, tmp_path):
    sc = spark.sparkContext
    before = sc._jsc.sc().getCheckpointDir()
    shared_dir(spark)
    home = Path(sc._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    old = set(home.iterdir())
    corpus_pipeline.run(spark, folder).count()
    new = [p for p in home.iterdir() if p not in old]
    assert [p.name.split("-")[0] for p in new] == ["pipeline"] and [p.name for p in new[0].iterdir()] == ["4"]
    assert before is not None


@pytest.mark.parametrize("name", ["op1_token_ids", "op2_secret_scan", "op3_pii", "op5_simhash", "op6_bpe", "op8_quality", "op9_sharding", "op10_embedding_dedup"])
def test_queries_return_every_row(spark, sf, name):
    table = "embeddings" if "embedding" in name else "documents"
    assert QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/{table}.parquet").count()
