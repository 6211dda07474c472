"""Compares a query with its SQL on DuckDB, whatever the order of rows."""

import math
from pathlib import Path

import duckdb


def plain(x):
    if x is None or x != x:
        return None
    if isinstance(x, bool) or type(x).__name__ == "bool_":
        return bool(x)
    if isinstance(x, (int, float)) or hasattr(x, "dtype"):
        return int(x) if float(x).is_integer() else float(f"{float(x):.12g}")
    return str(x) if math else x


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(None if type(x).__name__ == "NAType" else plain(x) for x in r) for r in df.astype(object).itertuples(index=False)), key=repr)


def expected(sql, sf):
    with duckdb.connect() as c:
        for p in Path(sf).glob("*.parquet"):
            c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        return c.sql(sql).df()


def same(spark, queries, sql, name, sf):
    got, want = queries[name](spark, sf).toPandas(), expected(sql[name], sf)
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) > 0
    assert rows(got) == rows(want)
