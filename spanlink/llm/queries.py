"""Queries of the operators over the driver's tables, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.llm.common import shared_dir, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanlink.llm.token_ids import read_ids, write_ids

    path = f"{shared_dir(spark)}/token-ids-{uuid.uuid4()}"
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_ids(spark, path)


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanlink.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents")).drop("rid")


#: White space as op4's and op7's contracts list it.
_SQL_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL["op4_exact_dedup"] = """
WITH n AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanlink.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanlink.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents"))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanlink.llm.simhash import simhash_groups

    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanlink.llm.bpe import bpe_encode

    out = bpe_encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), packed=True, decoded=True)
    n = (F.octet_length("ids") / 4).cast("long")
    return out.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"))


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanlink.llm.embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op10_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(u, w) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.u, l.w FROM r JOIN l ON r.w = l.u),
c AS (SELECT u, min(w) AS component_id FROM r GROUP BY u), n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c ON c.u = vec_id LEFT JOIN n ON n.u = vec_id
"""


def _digest(spans: DataFrame, names: list[str], base: list[int], order: list[str]) -> DataFrame:
    from spanlink.llm.scan import joined

    own = F.filter("spans", lambda s: s["kind"].isin(base))

    def count(k: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{names[k]}")

    return spans.select("doc_id", *map(count, base), F.sha2(joined(own, names, order).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans"), names, order).alias("spans"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanlink.llm.secret_scan import KINDS, secret_spans

    return _digest(secret_spans(table(spark, sf_dir, "documents")), KINDS, [0, 1, 2], ["start", "kind", "end"])


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanlink.llm.pii import KINDS, pii_spans

    return _digest(pii_spans(table(spark, sf_dir, "documents")), KINDS, [0, 1, 2, 3], ["kind", "start", "end"])


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanlink.llm.quality import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("rid")
