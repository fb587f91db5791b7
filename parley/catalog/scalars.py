"""Scalar expressions over turns, documents and queries."""

from pyspark.sql import functions as F

from parley import constants as K
from parley.catalog import sql_views as V
from parley.catalog.base import query
from parley.catalog.sql_views import r, sql
from parley.functions import text as X
from parley.functions import triage as T
from parley.functions import vectors as W
from parley.plans.workspace import spread

ID = "SELECT call_id, turn_index::BIGINT AS turn_index, "
KEY = ["call_id", "turn_index"]
TEXT = F.col


def _on_turns(name, expression, sql_expression, out):
    """Register one text expression over all turns."""
    def run(t):
        return t.turns.select(*KEY, expression(F.col("text")).alias(out))
    query(sql(f"{ID}{sql_expression} AS {out} FROM turns", "turns"), name=name)(run)


_on_turns("classify_intent", T.classify_intent, V.intent_sql(), "intent")
_on_turns("analyze_sentiment", T.analyze_sentiment, V.sentiment_sql(), "sentiment")
_on_turns("high_keywords", T.high_keywords,
          f"to_json({V.found('lower(text)', K.HIGH_KEYWORDS)})::VARCHAR", "keywords")
_on_turns("medium_keywords", T.medium_keywords,
          f"to_json({V.found('lower(text)', K.MEDIUM_KEYWORDS)})::VARCHAR", "keywords")
_on_turns("extract_products", T.extract_products, f"to_json({V.products_sql()})::VARCHAR", "products")
_on_turns("extract_issues", T.extract_issues,
          f"to_json({V.found('lower(text)', K.ISSUE_MENTIONS)})::VARCHAR", "issues")
_on_turns("is_greeting", X.is_greeting, V.any_rx("text", K.GREETING_RX), "is_greeting")
_on_turns("is_closing", X.is_closing, V.any_rx("text", K.CLOSING_RX), "is_closing")
_on_turns("is_hold", X.is_hold, V.any_rx("text", K.HOLD_RX), "is_hold")
_on_turns("is_resolution", X.is_resolution, V.any_rx("text", K.RESOLUTION_RX), "is_resolution")
_on_turns("procedural_ratio", X.procedural_ratio,
          r(f"{V.count_rx('text', K.PROCEDURAL_RX)} / greatest({V.n_words('text')} / 5.0::DOUBLE, 1::DOUBLE)"),
          "ratio")
_on_turns("has_negative_words", X.has_negative_words,
          V.any_of("lower(text)", K.NEGATIVE_WORDS), "is_negative")
_KI = (f"least(len({V.found('lower(text)', K.IMPORTANT_WORDS)}) * 0.3::DOUBLE "
       f"+ len({V.found('lower(text)', K.USEFUL_WORDS)}) * 0.1::DOUBLE, 1::DOUBLE)")
_on_turns("keyword_importance", X.keyword_importance, r(_KI), "importance")

_CLEAN = V.squeeze(f"regexp_replace(text, {V.lit('(?i)' + K.FILLER_RX)}, '', 'g')")
_on_turns("clean_fillers", X.clean_fillers, _CLEAN, "cleaned")


def full_clean_sql(t="text"):
    """The long filler list; its two look-aheads are protected by a marker letter."""
    t = f"regexp_replace({t}, '(?i)\\b(l)(ike to)', '\\1' || chr(1) || '\\2', 'g')"
    t = f"regexp_replace({t}, '(?i)\\b(a)(ctually [A-Za-z0-9_])', '\\1' || chr(1) || '\\2', 'g')"
    for p in K.FILLER_FULL_RX:
        p = p.replace(r"(?! to)", "").replace(r"(?! \w)", "")
        t = f"regexp_replace({t}, {V.lit('(?i)' + p)}, '', 'g')"
    t = f"replace({t}, chr(1), '')"
    return f"regexp_replace({V.squeeze(t)}, '\\s+([,.])', '\\1', 'g')"


_on_turns("clean_fillers_full", X.clean_fillers_full, full_clean_sql(), "cleaned")


@query(sql(f"{ID}{r('importance_score')} AS importance_score FROM seg", "seg"))
def importance_score(t):
    return t.segments.select(*KEY, "importance_score")


@query(sql(f"""{ID}requires_llm_enrichment, is_critical FROM seg""", "seg"))
def triage_flags(t):
    return t.segments.select(*KEY, "requires_llm_enrichment", "is_critical")


@query(sql(f"""SELECT segment_id, call_id, turn_index::BIGINT AS turn_index, speaker, text, intent,
 sentiment, {r('importance_score')} AS importance_score, requires_llm_enrichment, is_critical,
 to_json(high_priority_keywords)::VARCHAR AS high_priority_keywords,
 to_json(medium_priority_keywords)::VARCHAR AS medium_priority_keywords,
 to_json(products_mentioned)::VARCHAR AS products_mentioned, to_json(issues_mentioned)::VARCHAR AS issues_mentioned
FROM seg""", "seg"))
def analyze_segments(t):
    return t.segments


_ALT = f"""greatest(0::DOUBLE, least(1::DOUBLE,
 ({V.case_map('intent', K.ALT_INTENT, '0::DOUBLE')}) * 0.4::DOUBLE
 + ({V.case_map('sentiment', K.ALT_SENTIMENT, '0::DOUBLE')}) * 0.2::DOUBLE
 + (least(n_high * 0.5::DOUBLE, 1::DOUBLE) + least(n_medium * 0.25::DOUBLE, 0.5::DOUBLE)) * 0.3::DOUBLE
 + CASE WHEN lower(speaker) = 'customer' THEN 1::DOUBLE ELSE 0::DOUBLE END * 0.1::DOUBLE))"""


@query(sql(f"{ID}{r(_ALT)} AS importance FROM seg", "seg"))
def weighted_importance(t):
    return t.segments.select(*KEY, T.weighted_importance(
        F.col("intent"), F.col("sentiment"), F.size("high_priority_keywords"),
        F.size("medium_priority_keywords"), T.is_customer(F.col("speaker"))).alias("importance"))


@query(sql(f"{ID}{V.level_sql('importance_score')} AS level FROM seg", "seg"))
def importance_level(t):
    return t.segments.select(*KEY, T.importance_level(F.col("importance_score")).alias("level"))


@query(sql(f"""{ID}to_json(issues_mentioned)::VARCHAR AS encoded FROM seg""", "seg"))
def encode_list(t):
    return t.segments.select(*KEY, X.encode_list(F.col("issues_mentioned")).alias("encoded"))


@query(sql("""SELECT event_id, props, to_json([props])::VARCHAR AS decoded_props,
 to_json([event_type, 'x'])::VARCHAR AS decoded_list FROM events"""))
def decode_list(t):
    """JSON objects are not lists and stay whole; encoded lists come back."""
    encoded = X.encode_list(F.array(F.col("event_type"), F.lit("x")))
    return t.table("events").select("event_id", "props",
                                    X.decode_list(F.col("props")).alias("decoded_props"),
                                    X.decode_list(encoded).alias("decoded_list"))


@query(sql(f"""SELECT doc_id, {V.n_words('text')} AS n_words FROM documents"""))
def word_count(t):
    return t.table("documents").select("doc_id", X.word_count(F.col("text")).alias("n_words"))


@query(sql("""SELECT doc_id, (length(text) // 4)::BIGINT AS n_tokens FROM documents"""))
def approx_tokens(t):
    return t.table("documents").select("doc_id", X.approx_tokens(F.col("text")).alias("n_tokens"))


_COST = """(tin / 1000.0::DOUBLE) * CASE WHEN contains(model, 'gpt-4') THEN 0.01::DOUBLE ELSE 0.0015::DOUBLE END
 + (tout / 1000.0::DOUBLE) * CASE WHEN contains(model, 'gpt-4') THEN 0.03::DOUBLE ELSE 0.002::DOUBLE END"""


@query(sql(f"""SELECT event_id, {r(_COST)} AS cost FROM (SELECT event_id, length(props) * 100 AS tin,
 floor(value) AS tout, CASE WHEN event_type = 'purchase' THEN 'gpt-4-turbo-preview' ELSE 'gpt-3.5-turbo' END
 AS model FROM events)"""))
def llm_cost(t):
    model = F.when(F.col("event_type") == "purchase", K.EXPENSIVE_MODEL).otherwise(K.CHEAP_MODEL)
    return t.table("events").select("event_id", T.model_cost(
        F.length("props") * 100, F.floor("value"), model).alias("cost"))


def jaccard_sql(a, b):
    """Trigram Jaccard of two texts."""
    ga, gb = (f"list_distinct([substr({x}, i, 3) FOR i IN range(1, length({x}) - 1)])"
              for x in (a, b))
    return (f"CASE WHEN length({a}) < 3 OR length({b}) < 3 THEN 0::DOUBLE ELSE "
            f"len(list_intersect({ga}, {gb}))::DOUBLE / "
            f"len(list_distinct(list_concat({ga}, {gb}))) END")


@query(sql(f"""SELECT a.call_id, a.turn_index::BIGINT AS turn_index, {r(jaccard_sql('a.text', 'b.text'))} AS similarity
FROM turns a JOIN turns b ON a.call_id = b.call_id AND b.turn_index = a.turn_index + 1""", "turns"))
def trigram_jaccard(t):
    """Texts travel to their neighbours, and are cut into trigrams there, once per turn and side."""
    a = t.turns.select(*KEY, "text").repartition(*KEY)
    b = t.turns.select("call_id", (F.col("turn_index") - 1).alias("turn_index"), "text").repartition(*KEY)
    cut = lambda side, name: side.select(*KEY, X.trigram_codes(F.col("text")).alias(name))
    return cut(a, "grams").join(spread(cut(b, "next_grams")), KEY).select(*KEY, X.trigram_jaccard(
        F.col("grams"), F.col("next_grams"), cut=True).alias("similarity"))


@query(sql(f"""{ID}{r('1::DOUBLE - abs(0.5::DOUBLE - turn_index / n::DOUBLE) * 2::DOUBLE')} AS position_score
FROM turns JOIN (SELECT call_id, count(*) AS n FROM turns GROUP BY 1) USING (call_id)""", "turns"))
def position_score(t):
    from parley.operators.turns import with_turn_counts
    return with_turn_counts(t.turns).select(*KEY, X.position_score(
        F.col("turn_index"), F.col("n_turns")).alias("position_score"))


_QUALITY = f"""least(0.5::DOUBLE + CASE WHEN {V.n_words('s')} BETWEEN 100 AND 300 THEN 0.2::DOUBLE ELSE 0::DOUBLE END
 + CASE WHEN {V.rx('s', K.SUMMARY_ISSUE_RX)} THEN 0.1::DOUBLE ELSE 0::DOUBLE END
 + CASE WHEN {V.rx('s', K.SUMMARY_RESOLUTION_RX)} THEN 0.1::DOUBLE ELSE 0::DOUBLE END
 + CASE WHEN {V.rx('s', K.SUMMARY_PARTY_RX)} THEN 0.1::DOUBLE ELSE 0::DOUBLE END, 1::DOUBLE)"""


@query(sql(f"""SELECT call_id, {r(_QUALITY)} AS quality FROM (SELECT call_id,
 string_agg(concat(upper(speaker), ': ', text), chr(10) ORDER BY turn_index) AS s FROM turns GROUP BY 1)""",
           "turns"))
def summary_quality_score(t):
    from parley.sources.transcripts import assemble_transcript
    return assemble_transcript(t.turns).select("call_id", X.summary_quality(
        F.col("transcript_text")).alias("quality"))


@query(sql("""SELECT call_id, CASE WHEN overall_importance = 'critical' THEN 'gpt-4-turbo-preview'
 ELSE 'gpt-3.5-turbo' END AS model, CASE overall_importance WHEN 'critical' THEN 'gpt-4'
 WHEN 'high' THEN 'gpt-3.5-turbo' WHEN 'medium' THEN 'gpt-3.5' END AS tiered_model,
 'gpt-4-turbo-preview' AS forced_model FROM pc""", "pc"))
def select_model(t):
    level = F.col("overall_importance")
    return t.pc.select("call_id", T.select_model(level).alias("model"),
                       T.select_model_tiered(level).alias("tiered_model"),
                       T.select_model(level, force=True).alias("forced_model"))


@query(sql("""SELECT call_id, date_trunc('hour', call_timestamp)::TIMESTAMP AS hourly,
 date_trunc('day', call_timestamp)::TIMESTAMP AS daily,
 date_trunc('week', call_timestamp)::TIMESTAMP AS weekly,
 date_trunc('month', call_timestamp)::TIMESTAMP AS monthly FROM calls""", "calls"))
def period_trunc(t):
    return t.calls.select("call_id", *[X.period_trunc(F.col("call_timestamp"), p).alias(p)
                                       for p in ("hourly", "daily", "weekly", "monthly")])


@query(sql(f"""SELECT vec_id, i AS slot, {r('u[i]')} AS x, {r('z[i]')} AS z FROM (SELECT vec_id, u, z,
 unnest(range(1, len(u) + 1)) AS i FROM (SELECT vec_id,
 [v::DOUBLE / sqrt(list_sum([w::DOUBLE * w::DOUBLE FOR w IN s])) FOR v IN s] AS u,
 [0::DOUBLE FOR v IN s] AS z FROM (SELECT vec_id, [e * 3 FOR e IN embedding] AS s FROM embeddings)))"""))
def l2_normalize(t):
    """Scaled vectors become unit vectors again; zero vectors stay zero."""
    scaled = F.transform("embedding", lambda e: (e * F.lit(3).cast("float")))
    zero = F.transform("embedding", lambda e: F.lit(0.0))
    both = F.arrays_zip(W.l2_normalize(scaled).alias("x"), W.l2_normalize(zero).alias("z"))
    return t.table("embeddings").select("vec_id", F.posexplode(both).alias("slot", "v")).select(
        "vec_id", (F.col("slot") + 1).alias("slot"), "v.x", "v.z")


_CENTROIDS = """SELECT label, list(m ORDER BY i) AS centroid FROM (SELECT label, i,
 round(avg(embedding[i]::DOUBLE), 9) AS m FROM (SELECT label, embedding,
 unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY ALL) GROUP BY label"""
_COS = ("list_sum([embedding[i]::DOUBLE * centroid[i] FOR i IN range(1, len(centroid) + 1)]) / "
        "(sqrt(list_sum([e::DOUBLE * e::DOUBLE FOR e IN embedding])) * "
        "sqrt(list_sum([c * c FOR c IN centroid])))")


def label_centroids(t):
    """Mean vector of each label: a query table bounded by the number of labels."""
    e = t.table("embeddings").select("label", F.posexplode("embedding").alias("i", "e"))
    mean = e.groupBy("label", "i").agg(F.round(F.avg(F.col("e").cast("double")), 9).alias("m"))
    return mean.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(
        F.struct("i", "m"))), lambda x: x["m"]).alias("centroid"))


@query(sql(f"""SELECT vec_id, embeddings.label::BIGINT AS label, {r(_COS)} AS similarity
FROM embeddings JOIN ({_CENTROIDS}) c ON c.label = embeddings.label"""))
def cosine(t):
    """Every vector against the centroid of its label."""
    return t.table("embeddings").join(label_centroids(t), "label").select(
        "vec_id", "label", W.cosine(F.col("embedding"), F.col("centroid")).alias("similarity"))


@query(sql("""SELECT doc_id, concat(substr(text, 1, 150), '...') AS short_preview,
 concat(substr(text, 1, 300), '...') AS long_preview, printf('%.2f', round(n_chars / 7.0::DOUBLE, 2))
 AS number FROM documents"""))
def truncate_text(t):
    return t.table("documents").select(
        "doc_id", X.preview(F.col("text"), 150).alias("short_preview"),
        X.preview(F.col("text"), 300).alias("long_preview"),
        X.two_decimals(F.col("n_chars") / F.lit(7.0)).alias("number"))


@query(sql("""SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS parsed, NULL::TIMESTAMP AS unreadable
FROM events"""))
def parse_date_bounds(t):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t.table("events").select("event_id", X.parse_time(iso).alias("parsed"),
                                    X.parse_time(F.col("event_type")).alias("unreadable"))


@query(sql(f"""{ID}({V.case_map('intent', K.INTENT_SEVERITY, '0')})::BIGINT AS intent_severity,
 ({V.case_map('sentiment', K.SENTIMENT_SEVERITY, '0')})::BIGINT AS sentiment_severity FROM seg""", "seg"))
def severity(t):
    return t.segments.select(*KEY, T.intent_severity(F.col("intent")).alias("intent_severity"),
                             T.sentiment_severity(F.col("sentiment")).alias("sentiment_severity"))


@query(sql(f"{ID}concat(start_time::INT::VARCHAR, 's - ', end_time::INT::VARCHAR, 's') AS label FROM turns",
           "turns"))
def time_range_label(t):
    return t.turns.select(*KEY, X.time_range_label(F.col("start_time"), F.col("end_time"))
                          .alias("label"))
