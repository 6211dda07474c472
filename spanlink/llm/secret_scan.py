"""Operator 2: secret scans with multipart credential linking, in DataFrame operations only.

Assignments, access identifiers and long hexadecimal strings are reported wherever they are. Weak candidates (short assigned
secrets, account identifiers and endpoints) mean little alone: each is a part of a credential, and it's reported
only if a complementary part lies within its scope, the code points around it. The interval join of parts and
scopes is done in the order of the parts in a document: the furthest end in front of a part and the nearest start
behind it tell whether any part with the other role overlaps its scope, so no pairs of parts are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.llm.scan import joined, scan

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ACCOUNT = r"""(?i)(?<![A-Za-z0-9_])(?:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
ENDPOINT = r"""(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|ftp|ssh)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+"""

#: Kinds in the order of the result; assigned secrets that are too short for a base span are the weak kind secret.
KINDS = ["assign", "access", "hex", "secret", "account", "endpoint"]
#: Code points of a scope on both sides of a candidate.
SCOPE = 200
#: Shortest assigned secret of a base span, and of a weak candidate.
LONG, SHORT = 12, 6


def secret_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Spans of secrets in each text: rid, doc_id, spans (array of struct of start, kind, end).

    docs has doc_id and text; other columns are ignored. kind is a number of KINDS, offsets are code points, end is
    exclusive. A null text counts as empty and has no spans; a very long one is scanned whole. A row a document, so repeated rows give equal
    rows; spans that begin at the same place are all told. An empty table gives an empty result.
    """
    m = scan(docs, [ASSIGN, ACCESS, HEX, ACCOUNT, ENDPOINT])
    value = F.length(F.regexp_extract("text", ASSIGN, 2))
    kind = F.when(F.col("kind") == 0, F.when(value >= LONG, 0).when(value >= SHORT, 3)).when(F.col("kind") <= 2, F.col("kind")).otherwise(F.col("kind") + 1)
    m = m.select("rid", "doc_id", kind.alias("kind"), "start", "end")

    front = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)

    def overlaps(others: Column, reach: int) -> Column:
        """Whether one of the others overlaps the span widened by reach."""
        ahead = F.max(F.when(others, F.col("end"))).over(front) > F.col("start") - reach
        after = F.min(F.when(others, F.col("start"))).over(behind) < F.col("end") + reach
        return F.coalesce(ahead, F.lit(False)) | F.coalesce(after, F.lit(False))

    k = F.col("kind")
    secret, identifier, endpoint, base = k.isin(0, 2, 3), k.isin(1, 4), k == 5, k <= 2
    m = m.withColumns({"__secret": overlaps(secret, scope), "__identifier": overlaps(identifier, scope), "__endpoint": overlaps(endpoint, scope), "__covered": overlaps(base, 0)})
    linked = F.when(k == 3, F.col("__identifier") | F.col("__endpoint")).when(k == 4, F.col("__secret")).when(k == 5, F.col("__secret") | F.col("__identifier"))
    keep = base | (linked & ~F.col("__covered"))
    return m.groupBy("rid", "doc_id").agg(F.collect_list(F.when(keep, F.struct("start", "kind", "end"))).alias("spans"))
