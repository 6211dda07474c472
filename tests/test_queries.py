import pytest

from spanlink.plans.queries import ORACLE_SQL, QUERIES
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    same(spark, QUERIES, ORACLE_SQL, name, sf)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE_SQL.keys()))
def test_query_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_plans_have_no_cross_joins_or_python(spark, sf):
    for name in ("link_full", "link_nearest", "mention_scan", "greedy_dedup"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert "Python" not in plan and "Pandas" not in plan


def test_scans_read_only_what_they_need(spark, sf):
    plan = QUERIES["sentence_spans"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
