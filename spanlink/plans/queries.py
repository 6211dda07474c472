"""Queries of the extraction, linking and scoring operators over the driver's tables, and their SQL for DuckDB.

The driver's documents are invented prose, so the queries use a lexicon of frequent words of their languages; confidences
are arithmetic on offsets, which any engine can repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.config import Config
from spanlink.functions import similarity
from spanlink.functions.text import mention_offset
from spanlink.operators import corpus, graph, link, match, report, score, segment, spans
from spanlink.operators.mentions import coref_pairs, lexicon_mentions, lexicon_table
from spanlink.plans.extract import document_records, extract_documents, numbered

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

LEXICON = {
    "event": ["with", "this", "de la", "of the", "der die"],
    "food crisis": ["was", "that the", "pour", "mit"],
    "location": ["from", "by", "le", "für", "que", "the of"],
    "date": ["for", "den", "un"],
}
GAZETTEER = {"weather shocks": ["the", "est", "und", "de"]}
CONFIG = Config(macro=r"(?i)\bthe\s+(?:the|of|and)\b", gazetteer=GAZETTEER, source_verbs=("heand", "onre", "and"), destination_verbs=("thand", "of"))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.spread(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def _confident(m: DataFrame, source: str = "model") -> DataFrame:
    return m.withColumns({"confidence": F.pmod(F.col("start") * 7919 + F.col("doc_id") * 104729, F.lit(1000)) / F.lit(1000.0), "source": F.lit(source)})


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(_confident(lexicon_mentions(_docs(spark, sf_dir), lexicon_table(spark, LEXICON))))


def _gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = lexicon_mentions(_docs(spark, sf_dir), lexicon_table(spark, GAZETTEER))
    return numbered(m.withColumns({"confidence": F.lit(1.0), "source": F.lit("gazetteer")}))


def _coref(entities: DataFrame) -> DataFrame:
    """Every date mention refers to the first location that begins at most 400 code points before it, or else to nothing."""
    d = entities.filter("label = 'date'").select("doc_id", F.col("start").alias("m_start"), F.col("end").alias("m_end"))
    l = entities.filter("label = 'location'").select("doc_id", F.col("start").alias("a_start"), F.col("end").alias("a_end"), F.col("text").alias("a_text"))
    x = d.join(l, "doc_id").filter("a_start < m_start and a_start >= m_start - 400")
    return x.groupBy("doc_id", "m_start", "m_end").agg(F.min(F.struct("a_start", "a_end", "a_text")).alias("a")).select("doc_id", "m_start", "m_end", "a.*")


# ---- SQL that several oracles share ------------------------------------------------------------------

_SENT = r"""
parts AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?])(\s+)|(\n\n+)', '\1' || chr(1) || '\2\3' || chr(1), 'g'), chr(1)) AS p FROM documents),
pieces AS (SELECT doc_id, unnest(p) AS s, generate_subscripts(p, 1) AS k, len(p) AS n FROM parts),
placed AS (SELECT *, coalesce(sum(length(s)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM pieces),
sent AS (SELECT doc_id, CAST((k - 1) // 2 AS INT) AS sent_idx, CAST(pos AS INT) AS s_start, CAST(pos + length(s) AS INT) AS s_end, s AS s_text FROM placed WHERE k % 2 = 1 AND NOT (k = n AND s = ''))
"""


def _terms(lexicon: dict[str, list[str]]) -> str:
    return ", ".join(f"('{t}', '{label}')" for label, terms in lexicon.items() for t in terms)


def _hits(name: str, lexicon: dict[str, list[str]]) -> str:
    return f"""
{name} AS (
  SELECT g.doc_id, v.label, g.text, CAST(g.s AS INT) AS "start", CAST(g.e AS INT) AS "end" FROM (
    SELECT doc_id, tok AS text, e - length(tok) AS s, e FROM toks
    UNION ALL SELECT doc_id, tok || ' ' || nxt, e - length(tok), e + 1 + length(nxt) FROM toks WHERE nxt_gap = ' ') g
  JOIN (VALUES {_terms(lexicon)}) v(term, label) ON lower(g.text) = v.term)
"""


_TOKS = r"""
listed AS (SELECT doc_id, sent_idx, s_start, regexp_extract_all(s_text, '[\p{L}\p{N}_]+') AS w, regexp_split_to_array(s_text, '[\p{L}\p{N}_]+') AS g FROM sent),
each_tok AS (SELECT doc_id, sent_idx, s_start, unnest(w) AS tok, unnest(g[1:len(w)]) AS gap, generate_subscripts(w, 1) AS k FROM listed),
toks AS (SELECT *, s_start + sum(length(tok) + length(gap)) OVER (PARTITION BY doc_id, sent_idx ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e,
         lead(tok) OVER (PARTITION BY doc_id, sent_idx ORDER BY k) AS nxt, lead(gap) OVER (PARTITION BY doc_id, sent_idx ORDER BY k) AS nxt_gap FROM each_tok)
"""
_MENTIONS = f"""{_SENT}, {_TOKS}, {_hits("hits", LEXICON)},
mentions AS (SELECT *, (("start" * 7919 + doc_id * 104729) % 1000) / 1000.0::DOUBLE AS confidence, 'model' AS source,
             row_number() OVER (PARTITION BY doc_id ORDER BY "start", "end", label, text) - 1 AS ord FROM hits)
"""
_THRESHOLD = "CASE label WHEN 'location' THEN 0.8 WHEN 'event' THEN 0.5 WHEN 'date' THEN 0.5 WHEN 'organization' THEN 0.6 WHEN 'food crisis' THEN 0.4 WHEN 'weather shocks' THEN 0.4 ELSE 0.3 END"


def _greedy(source: str, name: str = "entities") -> str:
    """Greedy selection by a fold over the sorted spans; a struct of the list is a span."""
    s = 'struct_pack("start" := "start", generic := label = \'event\', ord := CAST(ord AS INT), label := label, text := text, confidence := CAST(confidence AS DOUBLE), "end" := "end", source := source)'
    up = "struct_pack(\"start\" := a[-1].\"start\", generic := a[-1].generic, ord := a[-1].ord, label := b[1].label, text := a[-1].text, confidence := b[1].confidence, \"end\" := a[-1].\"end\", source := b[1].source)"
    return f"""
ok_{name} AS (SELECT * FROM {source} WHERE source = 'gazetteer' OR confidence >= {_THRESHOLD}),
list_{name} AS (SELECT doc_id, list({s} ORDER BY "start", label = 'event', ord) AS l FROM ok_{name} GROUP BY doc_id),
fold_{name} AS (SELECT doc_id, list_reduce(list_transform(l, lambda x: [x]), lambda a, b:
  CASE WHEN greatest(a[-1]."start", b[1]."start") < least(a[-1]."end", b[1]."end")
       THEN CASE WHEN b[1].label <> 'event' AND a[-1].label = 'event' THEN list_concat(a[1:len(a) - 1], [{up}]) ELSE a END
       ELSE list_concat(a, b) END) AS f FROM list_{name}),
{name} AS (SELECT doc_id, CAST(generate_subscripts(f, 1) - 1 AS INT) AS ord, unnest(f).label AS label, unnest(f).text AS text, unnest(f).confidence AS confidence,
           unnest(f)."start" AS "start", unnest(f)."end" AS "end", unnest(f).source AS source FROM fold_{name})
"""


_ENTITIES = f"{_MENTIONS}, {_greedy('mentions')}"
_AT = """
sent_at AS (SELECT *, unnest(generate_series(s_start // 512, greatest(s_end - 1, s_start) // 512)) AS b FROM sent),
located AS (SELECT e.*, s.sent_idx, s.s_text, s.s_start FROM (SELECT *, "start" // 512 AS b FROM entities) e JOIN sent_at s ON e.doc_id = s.doc_id AND e.b = s.b WHERE s.s_start <= e."start" AND e."start" < s.s_end),
ev AS (SELECT * FROM located WHERE label IN ('event', 'food crisis', 'weather shocks')),
loc AS (SELECT * FROM located WHERE label = 'location')
"""
_CARRIED = """
best AS (SELECT doc_id, sent_idx, arg_max(ord, struct_pack(c := confidence, o := -ord)) AS here FROM loc GROUP BY ALL),
carried AS (SELECT s.doc_id, s.sent_idx, s.s_text, b.here, last_value(b.here IGNORE NULLS) OVER w AS active, first_value(b.here IGNORE NULLS) OVER w AS first
            FROM sent s LEFT JOIN best b USING (doc_id, sent_idx)
            WINDOW w AS (PARTITION BY s.doc_id ORDER BY s.sent_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


def _pairs_sql(candidates: str) -> str:
    """Pairs of candidate rows (doc_id, sent_idx, e_ord, l_ord, k, cross_sentence, link_method)."""
    return f"""
cand AS ({candidates}),
firsts AS (SELECT c.*, e.text AS event_text, e.label AS event_label, e."start" AS event_start, e."end" AS event_end, e.confidence AS event_confidence,
           l.text AS location_text, l."start" AS location_start, l."end" AS location_end, l.confidence AS location_confidence,
           row_number() OVER (PARTITION BY c.doc_id, lower(e.text), lower(l.text), e.label ORDER BY c.sent_idx, c.e_ord, c.k) AS n
           FROM cand c JOIN entities e ON e.doc_id = c.doc_id AND e.ord = c.e_ord JOIN entities l ON l.doc_id = c.doc_id AND l.ord = c.l_ord)
"""


_PAIR_LIST = ", ".join(link.PAIR)
_SAME = "SELECT ev.doc_id, ev.sent_idx, ev.ord AS e_ord, loc.ord AS l_ord, loc.ord AS k, false AS cross_sentence, 'same_sentence' AS link_method FROM ev JOIN loc USING (doc_id, sent_idx)"
_NEAREST = """SELECT doc_id, sent_idx, e_ord, l_ord, k, cross_sentence, link_method FROM (
  SELECT ev.doc_id, ev.sent_idx, ev.ord AS e_ord, loc.ord AS l_ord, loc.ord AS k, false AS cross_sentence, 'same_sentence' AS link_method,
         row_number() OVER (PARTITION BY ev.doc_id, ev.sent_idx, ev.ord ORDER BY abs(loc."start" - ev."start"), loc.ord) AS n FROM ev JOIN loc USING (doc_id, sent_idx)) WHERE n = 1"""
_WATERFALL = f"""{_SAME} UNION ALL SELECT ev.doc_id, ev.sent_idx, ev.ord, c.active, 0, true, 'waterfall' FROM ev JOIN carried c USING (doc_id, sent_idx) WHERE c.here IS NULL AND c.active IS NOT NULL"""
_MACRO_SQL = r"regexp_matches(c.s_text, '(?i)\bthe\s+(the|of|and)\b')"
_NEAREST_ALL = f"""{_NEAREST} UNION ALL SELECT ev.doc_id, ev.sent_idx, ev.ord, CASE WHEN {_MACRO_SQL} THEN c.first ELSE c.active END, 0, true, CASE WHEN {_MACRO_SQL} THEN 'macro' ELSE 'waterfall' END
  FROM ev JOIN carried c USING (doc_id, sent_idx) WHERE c.here IS NULL AND c.active IS NOT NULL"""


# ---- corpus ------------------------------------------------------------------------------------------

_STOP = "'the','and','was','that','for','with','this','from','have','has','are','were','been','not','but','they','which'"
_PASS = rf"""
clean AS (SELECT doc_id, lang, source, regexp_replace(regexp_replace(coalesce(text, ''), '^\s+', ''), '\s+$', '') AS text FROM documents),
passed AS (SELECT * FROM clean WHERE length(text) BETWEEN 300 AND 3000 AND len(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda w: w IN ({_STOP}))) >= 3)
"""


@query(f"WITH {_PASS} SELECT doc_id, lang, length(text) AS text_length FROM passed")
def corpus_filter(spark, sf_dir):
    return corpus.corpus_filter(_table(spark, sf_dir, "documents")).select("doc_id", "lang", F.length("text").alias("text_length"))


@query(f"""WITH {_PASS.replace("FROM documents", "FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 10000)")}, capped AS (SELECT * FROM passed),
r AS (SELECT *, (doc_id * 1103515245 + 123 * 12345 + 1013904223) % 2147483647 AS r FROM capped)
SELECT doc_id, printf('article_%03d', row_number() OVER (ORDER BY r, doc_id) - 1) AS name FROM r ORDER BY r, doc_id LIMIT 100""")
def corpus_sample(spark, sf_dir):
    kept = corpus.corpus_filter(corpus.seen(_table(spark, sf_dir, "documents"), 10_000))
    return corpus.sample(kept, 100, seed=123).select("doc_id", "name")


@query("SELECT lang, count(*) AS docs, count(DISTINCT source) AS sources, min(length(text)) AS shortest, max(length(text)) AS longest, avg(length(text)) AS mean FROM documents GROUP BY lang")
def length_stats(spark, sf_dir):
    n = F.length("text")
    return _table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("docs"), F.countDistinct("source").alias("sources"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.avg(n).alias("mean"))


@query("SELECT doc_id, translate(substring(text, 1, 200), chr(10), ' ') AS preview FROM documents ORDER BY doc_id LIMIT 3")
def preview(spark, sf_dir):
    return corpus.preview(_docs(spark, sf_dir))


# ---- segments ----------------------------------------------------------------------------------------


@query(f"WITH {_SENT} SELECT * FROM sent")
def sentence_spans(spark, sf_dir):
    return segment.sentences(_docs(spark, sf_dir))


_CONTIG = f"""{_SENT},
bounds AS (SELECT DISTINCT doc_id, s_start AS a FROM sent UNION SELECT doc_id, 0 FROM documents WHERE coalesce(text, '') <> ''),
segs AS (SELECT b.doc_id, b.a, coalesce(lead(b.a) OVER (PARTITION BY b.doc_id ORDER BY b.a), length(d.text)) AS e, d.text AS t FROM bounds b JOIN documents d USING (doc_id)),
contig AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY a) - 1 AS INT) AS sent_idx, CAST(a AS INT) AS s_start, CAST(e AS INT) AS s_end, substring(t, a + 1, e - a) AS s_text
           FROM segs WHERE regexp_matches(substring(t, a + 1, e - a), '\\S'))
"""


@query(f"WITH {_CONTIG} SELECT * FROM contig")
def contiguous_spans(spark, sf_dir):
    return segment.contiguous(_docs(spark, sf_dir))


_CHUNKS = f"""{_CONTIG},
cl AS (SELECT doc_id, list(struct_pack(a := s_start, e := s_end) ORDER BY sent_idx) AS l FROM contig GROUP BY doc_id),
cf AS (SELECT doc_id, list_reduce(list_transform(l, lambda x: [x]), lambda p, q: CASE WHEN q[1].e - p[-1].a <= 1500 THEN list_concat(p[1:len(p) - 1], [struct_pack(a := p[-1].a, e := q[1].e)]) ELSE list_concat(p, q) END) AS f FROM cl),
chunks AS (SELECT doc_id, CAST(generate_subscripts(f, 1) - 1 AS INT) AS chunk_idx, unnest(f).a AS c_start, unnest(f).e AS c_end FROM cf)
"""


@query(f"WITH {_CHUNKS} SELECT c.*, substring(d.text, c_start + 1, c_end - c_start) AS c_text FROM chunks c JOIN documents d USING (doc_id)")
def chunk_spans(spark, sf_dir):
    return segment.chunks(_docs(spark, sf_dir))


@query("""WITH RECURSIVE c AS (
  SELECT doc_id, text, 0 AS chunk_idx, 0 AS a FROM documents WHERE coalesce(text, '') <> ''
  UNION ALL SELECT doc_id, text, chunk_idx + 1, e - 200 FROM (
    SELECT *, CASE WHEN a + 1500 < length(text) AND stop - 2 > 750 THEN a + stop ELSE a + 1500 END AS e FROM (
      SELECT *, 1500 - strpos(reverse(substring(text, a + 1, 1500)), ' .') - CASE WHEN strpos(reverse(substring(text, a + 1, 1500)), ' .') = 0 THEN 2000 ELSE 0 END + 1 AS stop FROM c)) WHERE e < length(text)),
b AS (SELECT *, 1500 - strpos(reverse(substring(text, a + 1, 1500)), ' .') - CASE WHEN strpos(reverse(substring(text, a + 1, 1500)), ' .') = 0 THEN 2000 ELSE 0 END + 1 AS stop FROM c),
f AS (SELECT doc_id, chunk_idx, a, least(CASE WHEN a + 1500 < length(text) AND stop - 2 > 750 THEN a + stop ELSE a + 1500 END, length(text)) AS e, text FROM b)
SELECT doc_id, CAST(chunk_idx AS INT) AS chunk_idx, CAST(a AS INT) AS c_start, CAST(e AS INT) AS c_end, substring(text, a + 1, e - a) AS c_text FROM f""")
def overlap_chunks(spark, sf_dir):
    return segment.overlap_chunks(_docs(spark, sf_dir))


# ---- mentions and spans ------------------------------------------------------------------------------


@query(f'WITH {_MENTIONS} SELECT doc_id, label, text, "start", "end" FROM mentions')
def mention_scan(spark, sf_dir):
    return lexicon_mentions(_docs(spark, sf_dir), lexicon_table(spark, LEXICON))


@query(f"WITH {_MENTIONS} SELECT doc_id, ord, label, confidence FROM mentions WHERE confidence >= {_THRESHOLD} AND label IN ('event', 'food crisis')")
def threshold_filter(spark, sf_dir):
    return spans.event_like(spans.above_threshold(_mentions(spark, sf_dir), CONFIG), CONFIG).select("doc_id", "ord", "label", "confidence")


_ENTITY = 'doc_id, ord, label, text, "start", "end"'


@query(f"WITH {_MENTIONS} SELECT {_ENTITY} FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(text), label ORDER BY ord) AS n FROM mentions) WHERE n = 1")
def exact_dedup(spark, sf_dir):
    return spans.exact_dedup(_mentions(spark, sf_dir)).select("doc_id", "ord", "label", "text", "start", "end")


@query(f"WITH {_ENTITIES} SELECT {_ENTITY}, confidence, source FROM entities")
def greedy_dedup(spark, sf_dir):
    return spans.greedy_dedup(_mentions(spark, sf_dir), CONFIG).select("doc_id", "ord", "label", "text", "start", "end", "confidence", "source")


@query(f"""WITH {_MENTIONS}, {_hits("gaz", GAZETTEER)}, both_in AS (SELECT doc_id, label, text, "start", "end", confidence, source FROM mentions UNION ALL SELECT doc_id, label, text, "start", "end", 1.0, 'gazetteer' FROM gaz),
pre AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY "start", "end", label, text) - 1 AS ord FROM both_in), {_greedy("pre")}
SELECT {_ENTITY}, confidence, source FROM entities""")
def gazetteer_pre_merge(spark, sf_dir):
    model = _mentions(spark, sf_dir).drop("ord")
    both = numbered(model.unionByName(_gazetteer(spark, sf_dir).drop("ord")))
    return spans.greedy_dedup(both, CONFIG).select("doc_id", "ord", "label", "text", "start", "end", "confidence", "source")


@query(f"""WITH {_ENTITIES}, {_hits("gaz", GAZETTEER)},
named AS (SELECT e.doc_id, e.ord, e."start", e."end", e.text, e.label, e.confidence, e.source,
          first(g.label ORDER BY g."start", g."end") AS g_label FROM entities e LEFT JOIN gaz g ON e.label = 'event' AND g.doc_id = e.doc_id AND greatest(g."start", e."start") < least(g."end", e."end")
          AND NOT EXISTS (SELECT 1 FROM entities f WHERE f.doc_id = e.doc_id AND f."start" < e."start" AND greatest(g."start", f."start") < least(g."end", f."end")) GROUP BY ALL),
added AS (SELECT g.* FROM gaz g WHERE NOT EXISTS (SELECT 1 FROM entities e WHERE e.doc_id = g.doc_id AND greatest(g."start", e."start") < least(g."end", e."end")))
SELECT doc_id, label, text, "start", "end", confidence, source FROM (
  SELECT doc_id, coalesce(g_label, label) AS label, text, "start", "end", CASE WHEN g_label IS NULL THEN confidence ELSE 1.0 END AS confidence, CASE WHEN g_label IS NULL THEN source ELSE 'gazetteer' END AS source FROM named
  UNION ALL SELECT doc_id, label, text, "start", "end", 1.0, 'gazetteer' FROM added)""")
def gazetteer_post_merge(spark, sf_dir):
    entities = spans.greedy_dedup(_mentions(spark, sf_dir), CONFIG)
    return spans.merge_gazetteer(entities, _gazetteer(spark, sf_dir)).select("doc_id", "label", "text", "start", "end", "confidence", "source")


_IN_CHUNKS = f"""{_MENTIONS}, {_CHUNKS.replace(_SENT + ",", "")},
inside AS (SELECT m.doc_id, m.label, m.text, m."start", m."end", m.ord, c.chunk_idx, ((("start" - c_start) * 7919 + m.doc_id * 104729) % 1000) / 1000.0::DOUBLE AS confidence
           FROM mentions m JOIN chunks c ON m.doc_id = c.doc_id AND c.c_start <= m."start" AND m."end" <= c.c_end)
"""


@query(f"""WITH {_IN_CHUNKS} SELECT doc_id, label, text, "start", "end", confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, label, lower(text) ORDER BY confidence DESC, chunk_idx, ord) AS n FROM inside) WHERE n = 1""")
def chunk_merge(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    c = segment.chunks(docs).select("doc_id", "chunk_idx", "c_start", "c_end", F.explode(F.sequence(F.floor(F.col("c_start") / link.BUCKET), F.floor((F.col("c_end") - 1) / link.BUCKET))).alias("b"))
    m = _mentions(spark, sf_dir).withColumn("b", F.floor(F.col("start") / link.BUCKET))
    x = m.join(c, ["doc_id", "b"]).filter("c_start <= start and end <= c_end")
    x = _confident(x.withColumns({"start": F.col("start") - F.col("c_start"), "end": F.col("end") - F.col("c_start")}))
    return spans.merge_chunks(x).select("doc_id", "label", "text", "start", "end", "confidence")


@query(f'WITH {_ENTITIES}, {_AT} SELECT doc_id, ord, "start", sent_idx FROM located')
def span_to_sentence(spark, sf_dir):
    entities = spans.greedy_dedup(_mentions(spark, sf_dir), CONFIG)
    return link.span_to_sentence(entities, segment.sentences(_docs(spark, sf_dir))).select("doc_id", "ord", "start", "sent_idx")


@query(f"WITH {_SENT} SELECT doc_id, sent_idx FROM sent WHERE regexp_matches(s_text, '(?i)\\bthe\\s+(the|of|and)\\b')")
def macro_scope(spark, sf_dir):
    return segment.sentences(_docs(spark, sf_dir)).filter(F.col("s_text").rlike(CONFIG.macro)).select("doc_id", "sent_idx")


@query("SELECT doc_id, CASE WHEN instr(lower(text), lower(substring(text, 11, 8))) > 0 THEN instr(lower(text), lower(substring(text, 11, 8))) - 1 END AS offset_in_text FROM documents")
def mention_offsets(spark, sf_dir):
    mention = F.upper(F.substring("text", 11, 8))
    return _docs(spark, sf_dir).select("doc_id", mention_offset(F.col("text"), mention).alias("offset_in_text"))


# ---- linking -----------------------------------------------------------------------------------------


def _linked(spark, sf_dir, linker: str, config: Config = CONFIG) -> DataFrame:
    docs = _docs(spark, sf_dir)
    entities = spans.greedy_dedup(_mentions(spark, sf_dir), config)
    return link.LINKERS[linker](entities, segment.sentences(docs), config)


@query(f"WITH {_ENTITIES}, {_AT}, {_pairs_sql(_SAME)} SELECT {_PAIR_LIST} FROM firsts WHERE n = 1")
def link_all(spark, sf_dir):
    return _linked(spark, sf_dir, "all")


@query(f"""WITH {_ENTITIES}, {_AT}, has AS (SELECT DISTINCT doc_id, sent_idx FROM loc),
source_of AS (SELECT s.doc_id, s.sent_idx, CASE WHEN h.sent_idx IS NOT NULL THEN s.sent_idx WHEN p.sent_idx IS NOT NULL THEN p.sent_idx ELSE x.sent_idx END AS from_idx
  FROM sent s LEFT JOIN has h ON h.doc_id = s.doc_id AND h.sent_idx = s.sent_idx LEFT JOIN has p ON p.doc_id = s.doc_id AND p.sent_idx = s.sent_idx - 1 LEFT JOIN has x ON x.doc_id = s.doc_id AND x.sent_idx = s.sent_idx + 1),
{_pairs_sql("SELECT ev.doc_id, ev.sent_idx, ev.ord AS e_ord, loc.ord AS l_ord, loc.ord AS k, from_idx <> ev.sent_idx AS cross_sentence, CASE WHEN from_idx = ev.sent_idx THEN 'same_sentence' ELSE 'neighbor' END AS link_method FROM ev JOIN source_of o USING (doc_id, sent_idx) JOIN loc ON loc.doc_id = ev.doc_id AND loc.sent_idx = o.from_idx")}
SELECT {_PAIR_LIST} FROM firsts WHERE n = 1""")
def link_neighbor(spark, sf_dir):
    return _linked(spark, sf_dir, "neighbor")


@query(f"WITH {_ENTITIES}, {_AT}, {_CARRIED}, {_pairs_sql(_WATERFALL)} SELECT {_PAIR_LIST} FROM firsts WHERE n = 1")
def link_waterfall(spark, sf_dir):
    return _linked(spark, sf_dir, "waterfall")


@query(f"WITH {_ENTITIES}, {_AT}, {_CARRIED}, {_pairs_sql(_NEAREST_ALL)} SELECT {_PAIR_LIST} FROM firsts WHERE n = 1")
def link_nearest(spark, sf_dir):
    return _linked(spark, sf_dir, "nearest")


# The forms of the queries' verbs.
_SRC, _DST = "heand|heands|heanded|heanding|onre|onres|onred|onring|and|ands|anded|anding", "thand|thands|thanded|thanding|of|ofs|ofed|ofing"


def _role_sql(row: str) -> str:
    front = f'lower(substring({row}.s_text, 1, {row}."start" - {row}.s_start))'
    verb = rf"regexp_extract({front}, '^.*(^|[^\p{{L}}\p{{N}}_])(({_SRC})|({_DST}))([^\p{{L}}\p{{N}}_])', 2, 's')"
    return rf"""CASE regexp_extract({front}, '(^|\s)(from|to|into|in)\s+(the\s+)?$', 2) WHEN 'from' THEN 'SOURCE' WHEN 'to' THEN 'DESTINATION' WHEN 'into' THEN 'DESTINATION'
      WHEN 'in' THEN CASE WHEN {verb} = '' THEN 'LOCATION' WHEN regexp_full_match({verb}, '{_SRC}') THEN 'SOURCE' ELSE 'DESTINATION' END ELSE 'LOCATION' END"""


@query(f'WITH {_ENTITIES}, {_AT} SELECT doc_id, ord, {_role_sql("located")} AS role FROM located')
def location_role(spark, sf_dir):
    entities = spans.greedy_dedup(_mentions(spark, sf_dir), CONFIG)
    return link.roles(entities, segment.sentences(_docs(spark, sf_dir)), CONFIG).select("doc_id", "ord", "role")


_COREF = """
coref AS (SELECT d.doc_id, d."start" AS m_start, d."end" AS m_end, min(l."start") AS a_start, arg_min(l."end", l."start") AS a_end FROM entities d JOIN entities l ON l.doc_id = d.doc_id AND l.label = 'location' AND d.label = 'date'
          AND l."start" < d."start" AND l."start" >= d."start" - 400 GROUP BY ALL),
known AS (SELECT doc_id, lower(text) AS key, min(ord) AS first, arg_max(ord, struct_pack(c := confidence, o := -ord)) AS rep, count(*) AS n FROM loc GROUP BY ALL),
major AS (SELECT doc_id, arg_max(rep, struct_pack(n := n, f := -first)) AS major FROM known GROUP BY doc_id),
resolved AS (SELECT c.doc_id, c.m_start, c.m_end, arg_min(k.rep, k.first) AS rep FROM coref c JOIN known k USING (doc_id) JOIN entities e ON e.doc_id = c.doc_id AND e.ord = k.rep
             WHERE (e."start" >= a_start AND e."end" <= a_end) OR (a_start >= e."start" AND a_end <= e."end") GROUP BY ALL),
coref_at AS (SELECT r.doc_id, s.sent_idx, arg_max(r.rep, struct_pack(c := e.confidence, m := -r.m_start, n := -r.m_end)) AS rep FROM resolved r JOIN entities e ON e.doc_id = r.doc_id AND e.ord = r.rep
             JOIN sent s ON s.doc_id = r.doc_id AND s.s_start <= r.m_start AND r.m_start < s.s_end GROUP BY ALL)
"""


def _full_sql(skip: str) -> str:
    barred = f"({_role_sql('loc')}) = 'DESTINATION'" + (f" AND ({_role_sql('ev')}) = 'SOURCE'" if skip == "source" else "")
    same = f"""SELECT doc_id, sent_idx, e_ord, l_ord, k, cross_sentence, link_method FROM (
  SELECT ev.doc_id, ev.sent_idx, ev.ord AS e_ord, loc.ord AS l_ord, loc.ord AS k, false AS cross_sentence, 'same_sentence' AS link_method,
         row_number() OVER (PARTITION BY ev.doc_id, ev.sent_idx, ev.ord ORDER BY abs(loc."start" - ev."start"), loc.ord) AS n FROM ev JOIN loc USING (doc_id, sent_idx) WHERE NOT ({barred})) WHERE n = 1"""
    far = f"""SELECT ev.doc_id, ev.sent_idx, ev.ord, coalesce(r.rep, CASE WHEN {_MACRO_SQL} THEN m.major END, c.active), 0, true, CASE WHEN r.rep IS NOT NULL OR ({_MACRO_SQL} AND m.major IS NOT NULL) THEN 'coref' ELSE 'waterfall' END
  FROM ev JOIN carried c USING (doc_id, sent_idx) LEFT JOIN coref_at r USING (doc_id, sent_idx) LEFT JOIN major m USING (doc_id)
  WHERE c.here IS NULL AND coalesce(r.rep, CASE WHEN {_MACRO_SQL} THEN m.major END, c.active) IS NOT NULL"""
    return f"WITH {_ENTITIES}, {_AT}, {_CARRIED}, {_COREF}, {_pairs_sql(f'{same} UNION ALL {far}')} SELECT {_PAIR_LIST} FROM firsts WHERE n = 1"


@query(_full_sql("source"))
def link_full(spark, sf_dir):
    entities = spans.greedy_dedup(_mentions(spark, sf_dir), CONFIG)
    return link.link_full(entities, segment.sentences(_docs(spark, sf_dir)), CONFIG, _coref(entities))


@query(_full_sql("any"))
def link_full_any(spark, sf_dir):
    from dataclasses import replace

    entities = spans.greedy_dedup(_mentions(spark, sf_dir), CONFIG)
    return link.link_full(entities, segment.sentences(_docs(spark, sf_dir)), replace(CONFIG, skip="any"), _coref(entities))


@query(f"WITH {_ENTITIES}, {_AT}, {_COREF} SELECT doc_id, major AS ord, e.text FROM major m JOIN entities e USING (doc_id) WHERE e.ord = m.major")
def major_location(spark, sf_dir):
    entities = spans.greedy_dedup(_mentions(spark, sf_dir), CONFIG)
    at = link.span_to_sentence(entities.filter("label = 'location'"), segment.sentences(_docs(spark, sf_dir)))
    major = link.major_location(at).select("doc_id", F.col("loc.start").alias("start"), F.col("loc.text").alias("text"))
    return major.join(entities.select("doc_id", "start", "ord"), ["doc_id", "start"]).select("doc_id", "ord", "text")


# ---- ids, relations, records -------------------------------------------------------------------------

_IDS = """
once AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(text) ORDER BY ord) AS n FROM mentions),
ids AS (SELECT doc_id, 'e' || row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS id, text, upper(label) AS label, "start", "end" FROM once WHERE n = 1)
"""


@query(f'WITH {_MENTIONS}, {_IDS} SELECT doc_id, id, text, label, "start", "end" FROM ids')
def entity_ids(spark, sf_dir):
    return graph.entity_ids(_mentions(spark, sf_dir))


@query(f"""WITH {_MENTIONS}, {_IDS}, edges AS (SELECT DISTINCT h.doc_id, lower(h.text) AS head, lower(t.text) AS tail FROM mentions h JOIN mentions t ON h.doc_id = t.doc_id AND t.ord = h.ord + 1 WHERE h.label <> 'location' AND t.label = 'location')
SELECT e.doc_id, a.id AS event_id, b.id AS location_id, 'occurred_in' AS relation_type FROM edges e JOIN ids a ON a.doc_id = e.doc_id AND lower(a.text) = e.head JOIN ids b ON b.doc_id = e.doc_id AND lower(b.text) = e.tail""")
def relations_join(spark, sf_dir):
    m = _mentions(spark, sf_dir)
    t = m.filter("label = 'location'").select("doc_id", (F.col("ord") - 1).alias("ord"), F.col("text").alias("tail"))
    edges = m.filter("label != 'location'").join(t, ["doc_id", "ord"]).select("doc_id", F.col("text").alias("head"), "tail", F.lit("occurred_in").alias("relation_type"))
    return graph.relations(graph.entity_ids(m), edges)


@query(f"""WITH {_MENTIONS}, f AS (SELECT doc_id, label, text, min("start") AS pos FROM mentions GROUP BY ALL) SELECT doc_id, label, string_agg(text, '|' ORDER BY pos, text) AS texts FROM f GROUP BY doc_id, label""")
def chunk_sets(spark, sf_dir):
    return graph.merge_sets(_mentions(spark, sf_dir)).withColumn("texts", F.array_join("texts", "|"))


_KINDS = ["natural_disaster", "armed_conflict", "political", "economic", "social_unrest", "accident", "ceremony", "health", "legal", "other", "rumour", "conflict"]
_PLACES = ["city", "country", "region", "facility", "venue", "other", "planet"]
_GRADES = ["low", "medium", "high", "critical", "deadly"]


def _cycled(values: list[str], known: int, other: str) -> str:
    return f"CASE WHEN (conv_id + turn) % {len(values)} < {known} THEN {values}[(conv_id + turn) % {len(values)} + 1] ELSE {other} END"


@query(f"""SELECT conv_id AS doc_id, string_agg(concat_ws('>', role, {_cycled(_KINDS, 10, "'other'")}, {_cycled(_PLACES, 6, "'other'")}, {_cycled(_GRADES, 4, "'none'")}), ',' ORDER BY turn) AS records, first(role ORDER BY turn) AS first_role FROM conversations GROUP BY conv_id""")
def record_merge(spark, sf_dir):
    """Records with all choices of types and severities, and some that aren't among them."""
    c = _table(spark, sf_dir, "conversations")
    at = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(len(values))) + 1).cast("int"))
    one = F.struct(F.col("role").alias("event_name"), at(_KINDS).alias("event_type"), F.lit("x").alias("location_name"), at(_PLACES).alias("location_type"), at(_GRADES).alias("severity"))
    r = graph.merge_records(c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_idx"), F.to_json(F.array(one)).alias("records")))
    k = graph.first_class(c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_idx"), F.col("role").alias("class")))
    listed = F.array_join(F.transform("records", lambda x: F.concat_ws(">", x["event_name"], x["event_type"], x["location_type"], F.coalesce(x["severity"], F.lit("none")))), ",")
    return r.join(k, "doc_id").select("doc_id", listed.alias("records"), F.col("class").alias("first_role"))


# ---- scores ------------------------------------------------------------------------------------------


@query(f"WITH {_ENTITIES} SELECT CASE WHEN label IN ('location', 'date', 'organization') THEN label ELSE 'event_or_risk' END AS category, count(*) AS mentions, count(DISTINCT lower(text)) AS texts FROM entities GROUP BY 1")
def entity_counts(spark, sf_dir):
    e = spans.greedy_dedup(_mentions(spark, sf_dir), CONFIG)
    return e.groupBy(score.category(F.col("label")).alias("category")).agg(F.count("*").alias("mentions"), F.countDistinct(F.lower("text")).alias("texts"))


@query("""WITH good AS (SELECT doc_id FROM labels WHERE quality = 1), toxic AS (SELECT doc_id FROM labels WHERE toxic = 1)
SELECT 'tp' AS part, doc_id FROM (SELECT doc_id FROM good INTERSECT SELECT doc_id FROM toxic) UNION ALL SELECT 'fp', doc_id FROM (SELECT doc_id FROM good EXCEPT SELECT doc_id FROM toxic)
UNION ALL SELECT 'fn', doc_id FROM (SELECT doc_id FROM toxic EXCEPT SELECT doc_id FROM good) UNION ALL SELECT 'any', doc_id FROM (SELECT doc_id FROM good UNION SELECT doc_id FROM toxic) UNION ALL SELECT 'bag', doc_id FROM (SELECT doc_id FROM good UNION ALL SELECT doc_id FROM toxic)""")
def set_ops(spark, sf_dir):
    labels = _table(spark, sf_dir, "labels")
    good, toxic = labels.filter("quality = 1").select("doc_id"), labels.filter("toxic = 1").select("doc_id")
    parts = {"tp": good.intersect(toxic), "fp": good.subtract(toxic), "fn": toxic.subtract(good), "any": good.union(toxic).distinct(), "bag": good.unionAll(toxic)}
    named = [x.select(F.lit(n).alias("part"), "doc_id") for n, x in parts.items()]
    out = named[0]
    for x in named[1:]:
        out = out.unionAll(x)
    return out


_BOTH = f"""{_ENTITIES}, {_AT}, {_CARRIED}, {_pairs_sql(_WATERFALL).replace("cand", "cand_p").replace("firsts", "f_pred")}, {_pairs_sql(_NEAREST_ALL).replace("cand", "cand_g").replace("firsts", "f_gold")},
pred AS (SELECT DISTINCT doc_id, lower(event_text) AS event, lower(location_text) AS location FROM f_pred WHERE n = 1),
gold AS (SELECT DISTINCT doc_id, lower(event_text) AS event, lower(location_text) AS location FROM f_gold WHERE n = 1),
matched AS (SELECT coalesce(p.doc_id, g.doc_id) AS doc_id, coalesce(p.event, g.event) AS event, coalesce(p.location, g.location) AS location, p.doc_id IS NOT NULL AS in_pred, g.doc_id IS NOT NULL AS in_gold
            FROM pred p FULL JOIN gold g ON p.doc_id = g.doc_id AND p.event = g.event AND p.location = g.location),
per_doc AS (SELECT d.doc_id, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (in_pred AND in_gold) AS tp, count(*) FILTER (in_pred AND NOT in_gold) AS fp, count(*) FILTER (NOT in_pred AND in_gold) AS fn FROM matched GROUP BY doc_id) USING (doc_id))
"""


def _scores_sql(rows: str) -> str:
    return f"""
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS "precision", CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall, CASE WHEN tp + fp + fn > 0 THEN tp::DOUBLE / (tp + fp + fn) ELSE 0 END AS jaccard FROM {rows}),
scored AS (SELECT *, CASE WHEN 1.0::DOUBLE * "precision" + recall > 0 THEN 2.0::DOUBLE * "precision" * recall / (1.0::DOUBLE * "precision" + recall) ELSE 0 END AS f1,
  CASE WHEN 0.25::DOUBLE * "precision" + recall > 0 THEN 1.25::DOUBLE * "precision" * recall / (0.25::DOUBLE * "precision" + recall) ELSE 0 END AS f05,
  CASE WHEN 4.0::DOUBLE * "precision" + recall > 0 THEN 5.0::DOUBLE * "precision" * recall / (4.0::DOUBLE * "precision" + recall) ELSE 0 END AS f2 FROM pr)
"""


def _pred_gold(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    keys = ["doc_id", F.lower("event_text").alias("event"), F.lower("location_text").alias("location")]
    return _linked(spark, sf_dir, "waterfall").select(*keys).distinct(), _linked(spark, sf_dir, "nearest").select(*keys).distinct()


@query(f"""WITH {_BOTH}, total AS (SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM per_doc), {_scores_sql("total")} SELECT tp, fp, fn, "precision", recall, f1, f05, f2, jaccard FROM scored""")
def micro_metrics(spark, sf_dir):
    pred, gold = _pred_gold(spark, sf_dir)
    return score.micro(score.per_document(pred, gold, ["doc_id", "event", "location"], _docs(spark, sf_dir)))


@query(f"""WITH {_BOTH}, {_scores_sql("per_doc")} SELECT round(avg(f1), 9) AS macro_f1, count(*) AS documents FROM scored""")
def macro_metrics(spark, sf_dir):
    pred, gold = _pred_gold(spark, sf_dir)
    return score.macro(score.per_document(pred, gold, ["doc_id", "event", "location"], _docs(spark, sf_dir))).withColumn("macro_f1", F.round("macro_f1", 9))


@query(f"""WITH {_BOTH}, other AS (SELECT doc_id, event, min(location) FILTER (in_pred) AS linked_to, min(location) FILTER (in_gold) AS expected FROM matched GROUP BY ALL)
SELECT m.doc_id, m.event, m.location, CASE WHEN in_gold THEN 'missed' ELSE 'wrong' END AS error, CASE WHEN in_gold THEN linked_to ELSE expected END AS instead FROM matched m JOIN other USING (doc_id, event) WHERE in_pred <> in_gold""")
def error_attribution(spark, sf_dir):
    return score.missed_and_wrong(*_pred_gold(spark, sf_dir))


# ---- similarity --------------------------------------------------------------------------------------

_RELAXED = r"""
said AS (SELECT conv_id, turn, lower(regexp_replace(text, '[^\x00-\x7F]', '?', 'g')) AS x, lower(lag(regexp_replace(text, '[^\x00-\x7F]', '?', 'g')) OVER (PARTITION BY conv_id ORDER BY turn)) AS y FROM conversations),
toks AS (SELECT *, list_distinct(regexp_extract_all(x, '[\p{L}\p{N}_]+')) AS v, list_distinct(regexp_extract_all(y, '[\p{L}\p{N}_]+')) AS w FROM said WHERE y IS NOT NULL),
pairs AS (SELECT *, len(list_intersect(v, w)) AS both_n, len(v) + len(w) AS n FROM toks)
"""


@query(f"""WITH {_RELAXED} SELECT conv_id, turn, round(greatest(CASE WHEN n > both_n THEN both_n::DOUBLE / (n - both_n) ELSE 0 END, CASE WHEN x <> '' AND y <> '' AND (contains(x, y) OR contains(y, x)) THEN 1.0 ELSE 0 END,
  CASE WHEN greatest(length(x), length(y)) > 0 THEN 1 - levenshtein(x, y)::DOUBLE / greatest(length(x), length(y)) ELSE 1 END), 6) AS similarity FROM pairs""")
def fuzzy_similarity(spark, sf_dir):
    """Of each turn to the one before; DuckDB's edit distance counts bytes, so other than ASCII is replaced for both engines."""
    from pyspark.sql import Window

    c = _table(spark, sf_dir, "conversations").withColumn("x", F.regexp_replace("text", r"[^\x00-\x7F]", "?"))
    c = c.withColumn("y", F.lag("x").over(Window.partitionBy("conv_id").orderBy("turn"))).filter("y is not null")
    return c.select("conv_id", "turn", F.round(similarity.relaxed(F.col("x"), F.col("y")), 6).alias("similarity"))


@query()
def fuzzy_match(spark, sf_dir):
    """Accepted locations against the article's mentions of other labels, and half of those of locations."""
    m = _mentions(spark, sf_dir)
    pred = spans.greedy_dedup(m, CONFIG).filter("label = 'location'")
    columns = ["doc_id", F.col("ord").alias("id"), "text"]
    return match.match(pred.select(*columns), m.filter("label != 'location' or start % 2 = 0").select(*columns), "relaxed", ["doc_id"])


@query("""WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), n AS (SELECT *, lead(vec_id) OVER w AS g, lead(v) OVER w AS u FROM e WINDOW w AS (PARTITION BY label ORDER BY vec_id))
SELECT vec_id AS p, g, round(list_cosine_similarity(v, u), 6) AS similarity FROM n WHERE g IS NOT NULL""")
def semantic_similarity(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("label").orderBy("vec_id")
    e = _table(spark, sf_dir, "embeddings").withColumns({"g": F.lead("vec_id").over(w), "u": F.lead("embedding").over(w)}).filter("g is not null")
    return e.select(F.col("vec_id").alias("p"), "g", F.round(similarity.cosine(F.col("embedding"), F.col("u")), 6).alias("similarity"))


# ---- runs of models ----------------------------------------------------------------------------------

# each order is an article, its status the model, and its line numbers the counts
_RUNS = """
runs AS (SELECT o_orderstatus || '-' || o_orderpriority AS model, o_orderkey AS doc_id, 1 + o_orderkey % 7 AS seconds, o_orderkey % 50 = 0 AS failed,
  o_orderkey % 5 AS ent_tp, o_custkey % 3 AS ent_fp, o_orderkey % 4 AS ent_fn, o_custkey % 4 AS pair_tp, o_orderkey % 3 AS pair_fp, o_custkey % 2 AS pair_fn FROM orders),
summary AS (SELECT model, count(*) FILTER (NOT failed) AS evaluated, count(*) FILTER (failed) AS errors, coalesce(sum(seconds) FILTER (NOT failed), 0)::DOUBLE AS total_s,
  sum(ent_tp) FILTER (NOT failed) AS etp, sum(ent_fp) FILTER (NOT failed) AS efp, sum(ent_fn) FILTER (NOT failed) AS efn, sum(pair_tp) FILTER (NOT failed) AS ptp, sum(pair_fp) FILTER (NOT failed) AS pfp, sum(pair_fn) FILTER (NOT failed) AS pfn FROM runs GROUP BY model),
pr AS (SELECT *, total_s / evaluated AS avg_s, etp::DOUBLE / (etp + efp) AS ep, etp::DOUBLE / (etp + efn) AS er, ptp::DOUBLE / (ptp + pfp) AS pp, ptp::DOUBLE / (ptp + pfn) AS ppr FROM summary),
scored AS (SELECT *, 2.0::DOUBLE * ep * er / (1.0::DOUBLE * ep + er) AS ent_f1, 2.0::DOUBLE * pp * ppr / (1.0::DOUBLE * pp + ppr) AS pair_f1 FROM pr),
eff AS (SELECT *, round_even(pair_f1 / log2(avg_s + 2), 4) AS efficiency FROM scored)
"""


def _runs(spark, sf_dir) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    c = {"ent_tp": "o_orderkey % 5", "ent_fp": "o_custkey % 3", "ent_fn": "o_orderkey % 4", "pair_tp": "o_custkey % 4", "pair_fp": "o_orderkey % 3", "pair_fn": "o_custkey % 2"}
    return o.selectExpr("o_orderstatus || '-' || o_orderpriority as model", "o_orderkey as doc_id", "cast(1 + o_orderkey % 7 as double) as seconds", "o_orderkey % 50 = 0 as failed", *[f"{e} as {n}" for n, e in c.items()])


@query(f"WITH {_RUNS} SELECT row_number() OVER (ORDER BY pair_f1 DESC, model) AS rank, model, evaluated, errors, avg_s, ent_f1, pair_f1, efficiency FROM eff")
def leaderboard(spark, sf_dir):
    return report.leaderboard(report.run_summary(_runs(spark, sf_dir)), "pair_f1").select("rank", "model", "evaluated", "errors", "avg_s", "ent_f1", "pair_f1", "efficiency")


@query(f"WITH {_RUNS} SELECT arg_min(model, struct_pack(a := -ent_f1, m := model)) AS best_entities, arg_min(model, struct_pack(a := -pair_f1, m := model)) AS best_pairs, arg_min(model, struct_pack(a := avg_s, m := model)) AS fastest, arg_min(model, struct_pack(a := -efficiency, m := model)) AS most_efficient FROM eff")
def champions(spark, sf_dir):
    return report.champions(report.run_summary(_runs(spark, sf_dir)))


@query("SELECT name, repo_id FROM (SELECT p_brand AS name, p_name AS repo_id, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part) WHERE n = 1 AND (name IN ('Brand#11', 'Brand#21', 'Brand#55') OR repo_id IN ('no such repository'))")
def model_selection(spark, sf_dir):
    p = _table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), F.col("p_name").alias("repo_id"), F.col("p_partkey").alias("ord"))
    return report.select_models(report.unique_models(p), ["Brand#11", "Brand#21", "Brand#55", "no such repository"]).select("name", "repo_id")


@query("SELECT p_brand AS name, p_name AS repo_id, CAST(p_size AS VARCHAR) AS params, CAST(NULL AS VARCHAR) AS family FROM part UNION ALL SELECT s_name, NULL, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier")
def registry_union(spark, sf_dir):
    """Two registries of different shapes as one."""
    p = _table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), F.col("p_name").alias("repo_id"), F.col("p_size").cast("string").alias("params"))
    s = _table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("family"))
    return p.unionByName(s, allowMissingColumns=True)


@query()
def document_record(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    out = extract_documents(docs, CONFIG, mentions=_mentions(spark, sf_dir).drop("ord"))
    return document_records(docs, out["entities"], out["pairs"])
