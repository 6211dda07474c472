"""Small tables for the operators' tests: odd texts, repeated rows, nulls, and extra columns with names that operators use themselves."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, kept boolean, fp long, size long, k long"

BASE = "the quick brown fox jumps over the lazy dog while a second fox sleeps near the old river bank and dreams of rain "


def docs(spark, texts, sources=None, ids=None):
    """documents of texts (None: null), with doc_id 0, 1 ... unless ids are given."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = sources or [f"s{i % 3}" for i in range(len(texts))]
    rows = [(i, t, "en", s, len(t or ""), 7, False, 7, 7, 7) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3) if rows else spark.createDataFrame([], SCHEMA)


def union_find(nodes, links):
    """The smallest node of each node's component."""
    up = {x: x for x in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}
