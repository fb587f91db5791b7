"""Personal data, audit, metrics, alerts, feedback and languages."""

from pyspark.sql import functions as F

from parley import constants as K
from parley.catalog import questions as QU                                # noqa: F401 (views)
from parley.catalog import sql_views as V
from parley.catalog import turns as TU
from parley.catalog.base import query
from parley.catalog.sql_views import lit, r, sql
from parley.operators import governance as G
from parley.operators import languages as LG
from parley.operators import questions as Q

KEY = ["call_id", "turn_index"]
ID = "SELECT call_id, turn_index::BIGINT AS turn_index"


def _found(t):
    arms = ", ".join(f"CASE WHEN regexp_matches({t}, {lit(rx)}) THEN {lit(k)} END" for k, rx in K.PII_RX.items())
    return f"[x FOR x IN [{arms}] IF x IS NOT NULL]"


def _n(t, kind):
    return f"len(regexp_extract_all({t}, {lit(K.PII_RX[kind])}))::BIGINT"


_COUNTS = ", ".join(f"{_n('text', k)} AS n_{k}" for k in K.PII_RX)
_TOTAL = " + ".join(_n("text", k) for k in K.PII_RX)
_REDACT = "text"
for _k in K.REDACTION_ORDER:
    _REDACT = f"regexp_replace({_REDACT}, {lit(K.PII_RX[_k])}, {lit(K.PII_TOKENS[_k])}, 'g')"


@query(sql(f"{ID}, to_json({_found('text')})::VARCHAR AS pii_types, {_COUNTS}, {_TOTAL} AS n_pii FROM turns", "turns"))
def detect_pii(t):
    return G.detect_pii(t.turns).select(*KEY, "pii_types", *[f"n_{k}" for k in K.PII_RX], "n_pii")


@query(sql(f"SELECT doc_id, to_json({_found('text')})::VARCHAR AS pii_types, {_COUNTS}, {_TOTAL} AS n_pii FROM documents"))
def detect_pii_documents(t):
    return G.detect_pii(t.table("documents")).select(
        "doc_id", "pii_types", *[f"n_{k}" for k in K.PII_RX], "n_pii")


@query(sql(f"{ID}, {_REDACT} AS redacted FROM turns", "turns"))
def redact_pii(t):
    return G.redact_pii(t.turns).select(*KEY, "redacted")


@query(sql(f"SELECT page_id, {_REDACT.replace('text', 'html')} AS redacted FROM pages"))
def redact_pii_pages(t):
    return G.redact_pii(t.table("pages"), "html").select("page_id", "redacted")


@query(sql(f"""SELECT pii_type, count(*) AS n_rows, count(DISTINCT call_id) AS n_keys,
 {r('count(*) / (SELECT count(*) FROM turns)')} AS row_share FROM (SELECT call_id, unnest({_found('text')}) AS pii_type FROM turns)
GROUP BY 1""", "turns"))
def pii_report(t):
    return G.pii_report(t.turns, "call_id")


@query(sql("""SELECT user_id, CASE WHEN event_type = 'view' THEN 'data_access' ELSE 'query' END AS action, 'call' AS resource_type,
 concat('CALL_', lpad(props->>'k', 6, '0')) AS resource_id, count(*) AS n_accesses FROM events GROUP BY ALL"""))
def audit_log_rollup(t):
    """Events as an audit log: views are accesses, the rest are queries."""
    call = F.concat(F.lit("CALL_"), F.lpad(F.get_json_object("props", "$.k"), 6, "0"))
    audit = t.table("events").select(
        "user_id", F.when(F.col("event_type") == "view", "data_access").otherwise("query")
        .alias("action"), F.lit("call").alias("resource_type"), F.array(call)
        .alias("calls_accessed"))
    return G.audit_log_rollup(audit)


@query(sql(f"""SELECT metric_key, {r('sum(value::DECIMAL(30, 6))::DOUBLE')} AS counter, {r('first(value ORDER BY ts DESC, event_id DESC)')} AS gauge
FROM (SELECT *, CASE WHEN event_type = 'signup' THEN event_type ELSE concat(event_type, '{{decile=', (props->>'k')::INT // 10, ',source=log}}') END
 AS metric_key FROM events) GROUP BY 1"""))
def metric_counters(t):
    """Signups carry no labels, the other events two."""
    decile = F.floor(F.get_json_object("props", "$.k").cast("int") / 10).cast("string")
    labels = F.when(F.col("event_type") != "signup", F.create_map(
        F.lit("source"), F.lit("log"), F.lit("decile"), decile))
    return G.metric_counters(t.table("events").select(
        F.col("event_type").alias("metric"), labels.alias("labels"), "value", "ts", "event_id"))


@query(sql(f"""SELECT date_trunc('day', ts)::TIMESTAMP AS day, {r('sum((value / 1000)::DECIMAL(30, 12))::DOUBLE')} AS cost_usd
FROM events GROUP BY 1"""))
def daily_burn(t):
    return G.daily_burn(t.table("events").withColumn("cost", F.col("value") / 1000))


@query()
def latency_percentiles(t):
    return G.latency_percentiles(t.query_log)


@query(sql("""SELECT hour, unnest([x FOR x IN [CASE WHEN e > 0.05::DOUBLE THEN 'HighErrorRate' END, CASE WHEN p > 10::DOUBLE THEN 'HighLatency' END,
 CASE WHEN c > 100::DOUBLE THEN 'CostSpike' END, CASE WHEN h < 0.3::DOUBLE THEN 'LowCacheHitRate' END,
 CASE WHEN r > 0.25::DOUBLE THEN 'HighEnrichmentRate' END] IF x IS NOT NULL]) AS alert FROM (
 SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) FILTER (WHERE is_error) / count(*) AS e,
  min(latency_ms) FILTER (WHERE rn >= 0.99::DOUBLE * n) * 50 / 1000.0::DOUBLE AS p, sum((latency_ms / 10)::DECIMAL(30, 9))::DOUBLE AS c,
  count(*) FILTER (WHERE cache_hit) / count(*) AS h, count(*) FILTER (WHERE mode = 'deep') / count(*) AS r
 FROM (SELECT *, row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY latency_ms) AS rn,
  count(*) OVER (PARTITION BY date_trunc('hour', ts)) AS n FROM deduped) GROUP BY 1)""", "deduped"))
def alert_rules(t):
    """Hourly alerts over the question log; deep questions count as enriched."""
    log = Q.dedupe_queries(t.query_log).withColumn("latency_ms", F.col("latency_ms") * 50) \
        .withColumn("cost", F.col("latency_ms") / 50 / 10)
    deep = log.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        (F.count_if(F.col("mode") == "deep") / F.count(F.lit(1))).alias("enrichment_rate"))
    return G.alert_rules(G.hourly_metrics(log).join(deep, "hour"))


@query(sql(f"""SELECT count(*) AS n, {r('count(*) FILTER (WHERE h) / count(*)')} AS helpful_share, {r('sum(x) / count(*)')} AS avg_rating,
 count(*) FILTER (WHERE h) / count(*) > 0.8::DOUBLE AS meets_thumbs, sum(x) / count(*) > 4::DOUBLE AS meets_rating
FROM (SELECT event_type <> 'error' AS h, least(5, 1 + floor(value / 20))::BIGINT AS x FROM events)"""))
def feedback_metrics(t):
    return G.feedback_metrics(t.table("events").select(
        (F.col("event_type") != "error").alias("helpful"),
        F.least(F.lit(5), 1 + F.floor(F.col("value") / 20)).alias("rating")))


def _language_sql(t="text"):
    n = {lang: f"len([w FOR w IN {TU.tokens_sql(t)} IF list_contains({V.words(ws)}, w)])"
         for lang, ws in G.FUNCTION_WORDS.items()}
    return f"""SELECT doc_id, lang, CASE WHEN en >= de AND en >= fr AND en >= es THEN 'en' WHEN de >= fr AND de >= es THEN 'de'
 WHEN fr >= es THEN 'fr' ELSE 'es' END AS detected FROM (SELECT doc_id, lang, {', '.join(f'{x} AS {k}' for k, x in n.items())} FROM documents)"""


@query(sql(_language_sql()))
def language_split(t):
    return G.language_split(t.table("documents")).select("doc_id", "lang", "detected")


@query(sql(f"""SELECT detected, count(*) AS n_docs, count(*) FILTER (WHERE lang = detected) AS n_right FROM ({_language_sql()}) GROUP BY 1"""))
def language_report(t):
    return G.language_report(G.language_split(t.table("documents")))


_LETTERS = "trim(regexp_replace(lower(text), '[^\\p{L}]+', ' ', 'g'))"
_GRAMS = f"""SELECT doc_id, lang, unnest(list_concat(regexp_extract_all(p, '...'), regexp_extract_all(p[2:], '...'), regexp_extract_all(p[3:], '...')))
  AS gram FROM (SELECT doc_id, lang, CASE WHEN t = '' THEN '' ELSE concat(' ', t, ' ') END AS p FROM (SELECT doc_id, lang, {_LETTERS} AS t FROM documents))"""
_SCORED = f"""WITH grams AS ({_GRAMS}),
 sample AS (SELECT doc_id FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) <= {LG.TEXTS_PER_LANGUAGE}),
 counts AS (SELECT lang, gram, count(*) AS n FROM grams WHERE doc_id IN (SELECT doc_id FROM sample) GROUP BY ALL),
 known AS (SELECT DISTINCT gram FROM (SELECT gram FROM counts
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) <= {LG.GRAMS_PER_LANGUAGE})),
 totals AS (SELECT lang AS l, sum(n) + (SELECT count(*) FROM known) AS total FROM counts WHERE gram IN (SELECT gram FROM known) GROUP BY 1),
 model AS (SELECT k.gram, l, ln((coalesce(n, 0) + 1) / total) AS p FROM known k JOIN totals ON TRUE LEFT JOIN counts c ON c.gram = k.gram AND c.lang = l),
 per_doc AS (SELECT doc_id, gram, count(*) AS n FROM grams GROUP BY ALL),
 sums AS (SELECT doc_id, l, sum(n * p) AS s, sum(n)::BIGINT AS n_known FROM per_doc JOIN model USING (gram) GROUP BY ALL),
 best AS (SELECT doc_id, first(l ORDER BY s DESC, l) AS l, max(n_known) AS n_known, list(s ORDER BY s DESC) AS ss FROM sums GROUP BY 1),
 scored AS (SELECT d.doc_id, d.lang, coalesce(g.n, 0)::BIGINT AS n_grams, coalesce(n_known, 0)::BIGINT AS n_known,
  CASE WHEN n_known >= {LG.MIN_KNOWN}::DOUBLE * g.n AND (len(ss) = 1 OR (ss[1] - ss[2]) / n_known >= {LG.MIN_LEAD}::DOUBLE) THEN l ELSE '{LG.UNKNOWN}' END AS language
  FROM documents d LEFT JOIN (SELECT doc_id, sum(n) AS n FROM per_doc GROUP BY 1) g USING (doc_id) LEFT JOIN best USING (doc_id))"""


def _scored(t):
    docs = t.table("documents")
    return LG.score(docs, LG.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id")


@query(sql(f"{_SCORED} SELECT doc_id, lang, n_grams, n_known, language FROM scored"))
def language_ngrams(t):
    """Languages by a model of three-letter grams, with an unknown class."""
    return _scored(t).select("doc_id", "lang", "n_grams", "n_known", "language")


@query(sql(f"""{_SCORED} SELECT lang, count(*) AS n_docs, count(*) FILTER (WHERE language = lang) AS n_right,
 count(*) FILTER (WHERE language = '{LG.UNKNOWN}') AS n_unknown FROM scored GROUP BY 1"""))
def language_ngram_accuracy(t):
    return LG.accuracy(_scored(t))
