"""Batch answers: questions of the log over the indexed call segments."""

from pyspark.sql import functions as F

from parley import constants as K
from parley.catalog import enrichment as EN                               # noqa: F401 (views)
from parley.catalog import questions as QU                                # noqa: F401 (views)
from parley.catalog import search as SE
from parley.catalog import turns as TU
from parley.catalog.base import query
from parley.catalog.sql_views import lit, r, sql, view
from parley.operators import answers as A
from parley.operators import governance as G
from parley.operators import questions as Q
from parley.operators.search import build_search_documents
from parley.plans.workspace import written

# --- SQL views --------------------------------------------------------------
view("asked", """SELECT md5(query_text) AS query_id, query_text, CASE max(CASE mode WHEN 'deep' THEN 2 WHEN 'balanced' THEN 1 ELSE 0 END)
 WHEN 2 THEN 'deep' WHEN 1 THEN 'balanced' ELSE 'cheap' END AS mode FROM query_log GROUP BY query_text""", "query_log")


def retrieval_views(prefix, docs):
    """Hybrid top ten of every question over `docs`; equal documents are scored once."""
    view(f"{prefix}_texts", f"SELECT document, count(*) AS n FROM {docs} GROUP BY 1", docs)
    view(f"{prefix}_tf", f"""SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(list_concat(w, [w[i] || ' ' || w[i + 1]
 FOR i IN range(1, len(w))])) AS term FROM (SELECT document AS k, [x FOR x IN {TU.tokens_sql('document')}
 IF NOT list_contains({SE.STOP}, x)] AS w FROM {prefix}_texts)) GROUP BY ALL""", f"{prefix}_texts")
    view(f"{prefix}_idf", f"""SELECT term, ln(((SELECT count(*) FROM {docs}) + 1) / (df + 1)::DOUBLE) + 1 AS idf FROM (
 SELECT term, sum(tf * n) AS total, sum(n) AS df FROM {prefix}_tf JOIN {prefix}_texts ON k = document GROUP BY 1)
 ORDER BY total DESC, term LIMIT {K.MAX_FEATURES}""", f"{prefix}_tf", docs)
    SE.weight_view(f"{prefix}_w", f"{prefix}_tf", f"{prefix}_idf")
    SE.gram_views(f"{prefix}_qtf", "asked", "query_id", "query_text")
    SE.weight_view(f"{prefix}_qw", f"{prefix}_qtf", f"{prefix}_idf")
    view(f"{prefix}_kw", f"""SELECT q.k AS query_id, d.k AS document, round(sum(q.w * d.w), 9) AS score
 FROM {prefix}_qw q JOIN {prefix}_w d USING (term) GROUP BY ALL HAVING round(sum(q.w * d.w), 9) > 0""",
         f"{prefix}_qw", f"{prefix}_w")
    TU.vector_views(f"{prefix}_dv", f"{prefix}_texts", "document", "document")
    TU.vector_views(f"{prefix}_qv", "asked", "query_id", "query_text")
    view(f"{prefix}_sem", f"""SELECT query_id, document, coalesce(round(s, 9), 0::DOUBLE) AS score FROM asked CROSS JOIN {prefix}_texts
 LEFT JOIN (SELECT q.k AS query_id, d.k AS document, sum(q.x * d.x) AS s FROM {prefix}_qv q JOIN {prefix}_dv d USING (slot)
  GROUP BY ALL) USING (query_id, document)""", f"{prefix}_qv", f"{prefix}_dv", "asked")
    side = lambda s: SE.top(f"(SELECT query_id, segment_id, score FROM {prefix}_{s} JOIN {docs} USING (document))", 20,
                            "query_id", "segment_id")
    merged = SE._merged(side("kw"), side("sem"), "query_id", "segment_id")
    view(f"{prefix}_hits", f"""SELECT h.query_id, h.segment_id, h.keyword_score, h.semantic_score, h.score, h.rank,
  d.call_id, d.text, d.product, d.intent, d.sentiment FROM ({SE.top(f'({merged})', 10, 'query_id', 'segment_id')}) h
 JOIN {docs} d USING (segment_id)""", f"{prefix}_kw", f"{prefix}_sem", docs)


retrieval_views("r", "search_docs")
view("vip_docs", "SELECT * FROM search_docs WHERE client_segment = 'vip' AND product IN ('etf', 'loan')", "search_docs")
retrieval_views("v", "vip_docs")
view("r_top", "SELECT * FROM r_hits WHERE rank <= 5", "r_hits")

_TWO = "printf('%.2f', round(score, 2))"
_BLOCK = f"""concat(chr(10), '[Call ', rank, ']', chr(10), 'Product: ', coalesce(product, 'N/A'), chr(10), 'Intent: ',
 coalesce(intent, 'N/A'), chr(10), 'Sentiment: ', coalesce(sentiment, 'N/A'), chr(10), 'Relevance: ', {_TWO}, chr(10), chr(10),
 'Transcript:', chr(10), text, chr(10), '---', chr(10))"""
view("contexts", f"""SELECT query_id, string_agg(block, chr(10) ORDER BY rank) AS context, count(*) AS n_blocks FROM (
 SELECT *, sum(length(block) // 4) OVER (PARTITION BY query_id ORDER BY rank) AS used FROM (
  SELECT query_id, rank, {_BLOCK} AS block FROM r_top)) WHERE used <= {K.CONTEXT_TOKENS} GROUP BY 1""", "r_top")
view("cited", f"""SELECT query_id, string_agg(concat('[', rank, '] Call ', call_id, ' - ', coalesce(product, 'N/A'), ' - Score: ', {_TWO}),
 chr(10) ORDER BY rank) AS citations FROM r_top GROUP BY 1""", "r_top")
view("sure", """SELECT query_id, coalesce(n, 0)::BIGINT AS n_sources, coalesce(c, 0::DOUBLE) AS confidence FROM asked LEFT JOIN (
 SELECT query_id, count(*) AS n, least(1::DOUBLE, sum(score) / count(*) * 0.7::DOUBLE + least(count(*) / 5.0::DOUBLE, 1::DOUBLE) * 0.3::DOUBLE) AS c
 FROM r_top GROUP BY 1) USING (query_id)""", "asked", "r_top")
view("answered", f"""SELECT query_id, query_text, mode, coalesce(output, {lit(K.ANSWER_NONE)}) AS answer, confidence, n_sources,
 coalesce(citations, '') AS citations, CASE WHEN output IS NULL THEN 'none' ELSE model END AS model_used,
 coalesce(tin + tout, 0)::BIGINT AS tokens_used, CASE WHEN output IS NULL THEN 0::DOUBLE ELSE
 (tin / 1000.0::DOUBLE) * CASE WHEN mode = 'deep' THEN 0.01::DOUBLE ELSE 0.0015::DOUBLE END
 + (tout / 1000.0::DOUBLE) * CASE WHEN mode = 'deep' THEN 0.03::DOUBLE ELSE 0.002::DOUBLE END END AS cost_usd
FROM (SELECT *, length(concat({lit(A.PROMPT_HEAD)}, chr(10), chr(10), 'User Question:', chr(10), query_text, chr(10), chr(10),
  'Relevant Call Transcripts:', chr(10), context, chr(10), chr(10), {lit(A.PROMPT_TAIL)})) // 4 AS tin, length(output) // 4 AS tout,
  CASE WHEN mode = 'deep' THEN 'gpt-4-turbo-preview' ELSE 'gpt-3.5-turbo' END AS model
 FROM asked LEFT JOIN contexts USING (query_id) LEFT JOIN cited USING (query_id) JOIN sure USING (query_id) LEFT JOIN (
  SELECT query_id, string_agg(concat('[', rank, '] ', text), chr(10) ORDER BY rank) AS output FROM r_top GROUP BY 1) USING (query_id))""",
     "asked", "contexts", "cited", "sure", "r_top")


# --- inputs -----------------------------------------------------------------
def _questions(t):
    return A.question_table(t.query_log)


def _documents(t):
    return written(build_search_documents(t.segments, t.enrichments, t.calls), "search-documents")


def _hits(t):
    """Retrieval results are small (k per question) and used several times."""
    return written(A.retrieve(_questions(t), _documents(t)), "hits")


# --- queries ----------------------------------------------------------------
_HIT = f"""query_id, segment_id, {r('keyword_score')} AS keyword_score, {r('semantic_score')} AS semantic_score,
 {r('score')} AS score, rank, call_id, text, product, intent, sentiment"""
_COLS = ["query_id", "segment_id", "keyword_score", "semantic_score", "score", "rank", "call_id",
         "text", "product", "intent", "sentiment"]


@query(sql(f"SELECT {_HIT} FROM r_hits", "r_hits"))
def retrieve(t):
    return _hits(t).select(*_COLS)


@query(sql(f"SELECT {_HIT} FROM v_hits", "v_hits"))
def retrieve_filtered(t):
    """Only segments of VIP clients about two products."""
    return A.retrieve(_questions(t), _documents(t), filters={
        "client_segment": "vip", "product": ["etf", "loan"]}).select(*_COLS)


@query(sql(f"SELECT {_HIT} FROM r_top", "r_top"))
def rerank(t):
    return A.rerank(_hits(t)).select(*_COLS)


@query(sql("SELECT query_id, context, n_blocks FROM contexts", "contexts"))
def build_context(t):
    return A.build_context(A.rerank(_hits(t)))


@query(sql("SELECT query_id, citations FROM cited", "cited"))
def citations(t):
    return A.citations(A.rerank(_hits(t)))


@query(sql(f"SELECT query_id, n_sources, {r('confidence')} AS confidence FROM sure", "sure"))
def answer_confidence(t):
    return A.answer_confidence(_questions(t), A.rerank(_hits(t)))


@query(sql(f"""SELECT * REPLACE ({r('confidence')} AS confidence, {r('cost_usd * 1000')} AS cost_usd) FROM answered""", "answered"))
def answer_table(t):
    """Costs are shown per thousand questions."""
    return A.answer_table(_questions(t), _hits(t)).withColumn("cost_usd", F.col("cost_usd") * 1000)


@query(sql(f"""SELECT query_id, query_text, CASE WHEN n IS NULL THEN {lit(K.SEARCH_NONE)} ELSE
 concat('Found ', n, ' relevant call segments:', chr(10), chr(10), lines) END AS answer,
 CASE WHEN n IS NULL THEN 0::DOUBLE ELSE 0.7::DOUBLE END AS confidence FROM asked LEFT JOIN (SELECT query_id, count(*) AS n,
 string_agg(concat(rank, '. ', substr(text, 1, 150), '...', chr(10), '   (Relevance: ', {_TWO}, ')', chr(10), chr(10)), ''
  ORDER BY rank) FILTER (WHERE rank <= 5) AS lines FROM r_hits GROUP BY 1) USING (query_id)""", "asked", "r_hits"))
def search_answer(t):
    return A.search_answer(_questions(t), _hits(t))


_SENT = ", ".join(f"count(*) FILTER (WHERE overall_sentiment = '{s}') AS {s}" for s in K.SENTIMENTS)
_ZERO = ", ".join(f"coalesce({s}, 0)::BIGINT AS {s}" for s in ("total_matching_calls", *K.SENTIMENTS))


@query(sql(f"""SELECT query_id, {_ZERO} FROM asked LEFT JOIN (SELECT query_id, count(*) AS total_matching_calls, {_SENT} FROM (
 SELECT DISTINCT query_id, call_id FROM r_hits) JOIN pc USING (call_id) GROUP BY 1) USING (query_id)""",
           "asked", "r_hits", "pc"))
def answer_analytics(t):
    return A.answer_analytics(_questions(t), _hits(t), t.pc)


@query(sql(f"""SELECT route, count(*) AS n_queries, {r('sum(cost::DECIMAL(30, 12))::DOUBLE')} AS total_cost FROM (
 SELECT CASE query_type WHEN 'aggregation' THEN 'analytics' WHEN 'search' THEN 'search' ELSE 'rag' END AS route,
  CASE query_type WHEN 'aggregation' THEN 0::DOUBLE WHEN 'search' THEN 0.001::DOUBLE ELSE cost_usd END AS cost
 FROM classified JOIN (SELECT query_text, cost_usd FROM answered) USING (query_text)) GROUP BY 1""", "classified", "answered"))
def route_stats(t):
    return Q.route_stats(Q.classify_queries(t.query_log), A.answer_table(_questions(t), _hits(t)))


@query(sql(f"""SELECT {r('avg(confidence)')} AS avg_confidence, {r("count(*) FILTER (WHERE citations <> '') / count(*)")} AS citation_rate,
 (SELECT {r('count(*) FILTER (WHERE requires_enrichment) / count(*)')} FROM pc) AS enrichment_rate FROM answered""",
           "answered", "pc"))
def quality_metrics(t):
    return G.quality_metrics(A.answer_table(_questions(t), _hits(t)), t.pc)


