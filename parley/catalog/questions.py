"""Question tables: routing, parsing, analytics answers, reuse."""


from parley import constants as K
from parley.catalog.base import query
from parley.catalog.sql_views import any_of, lit, r, sql, view
from parley.operators import questions as Q


def _hits(patterns):
    return "(" + " + ".join(f"regexp_matches(lower(query_text), {lit(p)})::INT" for p in patterns) + ")"


view("classified", f"""SELECT *, CASE WHEN confidence < 0.6::DOUBLE THEN 'hybrid' WHEN intent = 'analytics' THEN 'aggregation'
  ELSE intent END AS query_type, CASE WHEN confidence < 0.6::DOUBLE THEN ac > 0.3::DOUBLE ELSE intent = 'analytics' END AS route_to_analytics,
 CASE WHEN confidence < 0.6::DOUBLE THEN sc > 0.3::DOUBLE ELSE intent = 'search' END AS route_to_search,
 CASE WHEN confidence < 0.6::DOUBLE THEN ic > 0.3::DOUBLE ELSE intent = 'insight' END AS route_to_rag
FROM (SELECT *, greatest(ac, sc, ic) AS confidence, CASE WHEN ac >= sc AND ac >= ic THEN 'analytics' WHEN sc >= ic THEN 'search'
  ELSE 'insight' END AS intent FROM (SELECT * EXCLUDE (a, s, i), a / greatest(a + s + i, 1)::DOUBLE AS ac,
  s / greatest(a + s + i, 1)::DOUBLE AS sc, i / greatest(a + s + i, 1)::DOUBLE AS ic FROM (SELECT *,
   {_hits(K.ANALYTICS_RX)} AS a, {_hits(K.SEARCH_RX)} AS s, {_hits(K.INSIGHT_RX)} AS i FROM query_log)))""", "query_log")


@query(sql(f"""SELECT query_id, query_type, intent, {r('confidence')} AS confidence, route_to_analytics, route_to_search, route_to_rag
FROM classified""", "classified"))
def classify_queries(t):
    return Q.classify_queries(t.query_log).select(
        "query_id", "query_type", "intent", "confidence", "route_to_analytics", "route_to_search",
        "route_to_rag")


_PRODUCTS = ", ".join(f"CASE WHEN {any_of('q', ws)} THEN {lit(n)} END" for n, ws in K.QUESTION_PRODUCTS.items())


@query(sql(f"""SELECT query_id, to_json([x FOR x IN [{_PRODUCTS}] IF x IS NOT NULL])::VARCHAR AS products,
 to_json([x FOR x IN [CASE WHEN {any_of('q', K.QUESTION_COMPLAINT_WORDS)} THEN 'complaint' END,
  CASE WHEN {any_of('q', K.QUESTION_INQUIRY_WORDS)} THEN 'inquiry' END] IF x IS NOT NULL])::VARCHAR AS intents,
 CASE WHEN contains(q, 'negative') OR contains(q, 'unhappy') THEN '["negative"]'
  WHEN contains(q, 'positive') OR contains(q, 'happy') THEN '["positive"]' ELSE '[]' END AS sentiments,
 CASE WHEN regexp_matches(q, '\\blast (day|week|month|year)\\b')
  THEN to_json([regexp_extract(q, '\\blast (\\w+)\\b', 1)])::VARCHAR ELSE '[]' END AS timeframes
FROM (SELECT query_id, lower(query_text) AS q FROM query_log)""", "query_log"))
def extract_query_entities(t):
    return Q.extract_query_entities(t.query_log).select("query_id", "products", "intents",
                                                        "sentiments", "timeframes")


_KIND = " ".join(f"WHEN {any_of('q', ws)} THEN {lit(n)}" for n, ws in K.QUESTION_KINDS)
_PROD = " ".join(f"WHEN contains(q, {lit(w)}) THEN {lit(n)}" for w, n in reversed(K.ASKED_PRODUCTS))
_INT = " ".join(f"WHEN {any_of('q', ws)} THEN {lit(n)}" for n, ws in K.ASKED_INTENTS)
view("parsed", f"""SELECT query_id, kind, CASE WHEN kind IS NOT NULL THEN p END AS product,
 CASE WHEN kind IS NOT NULL THEN i END AS asked_intent, CASE WHEN kind IS NOT NULL THEN s END AS asked_sentiment
FROM (SELECT query_id, CASE {_KIND} END AS kind, CASE {_PROD} END AS p, CASE {_INT} END AS i,
 CASE WHEN contains(q, 'negative') THEN 'negative' WHEN contains(q, 'positive') THEN 'positive' END AS s
 FROM (SELECT query_id, lower(query_text) AS q FROM query_log))""", "query_log")


@query(sql("SELECT query_id, kind, product, asked_intent, asked_sentiment FROM parsed", "parsed"))
def parse_analytics_question(t):
    return Q.parse_analytics_question(t.query_log).select("query_id", "kind", "product",
                                                          "asked_intent", "asked_sentiment")


@query(sql("""SELECT p.query_id, p.kind, 'count' AS label, coalesce(n, 0)::BIGINT AS value FROM parsed p LEFT JOIN (
  SELECT s.product AS sp, s.asked_intent AS si, s.asked_sentiment AS ss, count(c.call_id) AS n
  FROM (SELECT DISTINCT product, asked_intent, asked_sentiment FROM parsed WHERE kind = 'count') s LEFT JOIN all_calls c
   ON (s.product IS NULL OR s.product = c.product) AND (s.asked_intent IS NULL OR s.asked_intent = c.overall_intent)
   AND (s.asked_sentiment IS NULL OR s.asked_sentiment = c.overall_sentiment) GROUP BY ALL)
 ON p.product IS NOT DISTINCT FROM sp AND p.asked_intent IS NOT DISTINCT FROM si AND p.asked_sentiment IS NOT DISTINCT FROM ss
 WHERE p.kind = 'count'
UNION ALL SELECT query_id, kind, overall_intent, n FROM parsed, (SELECT overall_intent, count(*) AS n FROM pc GROUP BY 1)
 WHERE kind IN ('percentage', 'top') AND asked_intent IS NOT NULL
UNION ALL SELECT query_id, kind, p.product, n FROM (SELECT query_id, kind, asked_intent FROM parsed),
 (SELECT product, count(*) AS n FROM calls GROUP BY 1) p WHERE kind IN ('percentage', 'top') AND asked_intent IS NULL
UNION ALL SELECT query_id, kind, strftime(d, '%Y-%m-%d'), n FROM parsed, (SELECT date_trunc('day', call_timestamp) AS d,
 count(*) AS n FROM calls GROUP BY 1 ORDER BY 1 DESC LIMIT 30) WHERE kind = 'trend'""", "parsed", "all_calls", "pc", "calls"))
def answer_analytics_questions(t):
    return Q.answer_analytics_questions(t.query_log, t.calls, t.pc)


view("misses", """SELECT lower(trim(query_text)) AS q, min(ts) AS m FROM query_log GROUP BY 1
 UNION ALL SELECT p.q, min(l.ts) FROM misses p JOIN query_log l ON lower(trim(l.query_text)) = p.q
  AND epoch_us(l.ts) - epoch_us(p.m) > 3600000000 GROUP BY p.q""", "query_log")
view("deduped", """SELECT l.*, m.m IS NULL OR row_number() OVER (PARTITION BY lower(trim(query_text)), ts ORDER BY query_id) > 1 AS cache_hit
 FROM query_log l LEFT JOIN misses m ON lower(trim(l.query_text)) = m.q AND l.ts = m.m""", "query_log", "misses")


@query(sql("SELECT query_id, sha256(lower(trim(query_text))) AS query_key, cache_hit FROM deduped", "deduped"))
def dedupe_queries(t):
    return Q.dedupe_queries(t.query_log).select("query_id", "query_key", "cache_hit")


@query(sql(f"""SELECT count(*) AS n_queries, count(*) FILTER (WHERE cache_hit) AS n_hits,
 {r('count(*) FILTER (WHERE cache_hit) / count(*)')} AS hit_rate FROM deduped""", "deduped"))
def cache_hit_rate(t):
    return Q.cache_hit_rate(Q.dedupe_queries(t.query_log))


@query(sql("SELECT query_type, count(*) AS n_queries FROM classified GROUP BY 1", "classified"))
def query_volume_by_type(t):
    return Q.query_volume_by_type(Q.classify_queries(t.query_log))


@query(sql("""SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(DISTINCT user_id) AS n_users FROM query_log GROUP BY 1""",
           "query_log"))
def daily_users(t):
    return Q.daily_users(t.query_log)


