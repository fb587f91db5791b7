"""SQL texts of the shared inputs, written independently of the Spark expressions.

Each view is a WITH item; `sql(body, *views)` adds the ones a query needs.
"""

from __future__ import annotations

from parley import constants as K
from parley.sources.views import QUESTIONS, SENTENCES


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(ws) -> str:
    return "[" + ", ".join(lit(w) for w in ws) + "]"


def any_of(col: str, ws) -> str:
    return "(" + " OR ".join(f"contains({col}, {lit(w)})" for w in ws) + ")"


def found(col: str, ws) -> str:
    return f"[k FOR k IN {words(ws)} IF contains({col}, k)]"


def rx(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, {lit('(?i)' + pattern)})"


def any_rx(col: str, patterns) -> str:
    return "(" + " OR ".join(rx(col, p) for p in patterns) + ")"


def count_rx(col: str, patterns) -> str:
    return "(" + " + ".join(f"{rx(col, p)}::INT" for p in patterns) + ")"


def case_map(col: str, table: dict, default: str) -> str:
    def value(v):
        return lit(v) if isinstance(v, str) else (f"{v}::DOUBLE" if isinstance(v, float) else str(v))
    arms = " ".join(f"WHEN {lit(k)} THEN {value(v)}" for k, v in table.items())
    return f"CASE {col} {arms} ELSE {default} END"


def n_words(col: str) -> str:
    clean = f"trim(regexp_replace({col}, '\\s+', ' ', 'g'))"
    return f"(CASE WHEN {clean} = '' THEN 0 ELSE len(string_split({clean}, ' ')) END)::BIGINT"


def squeeze(col: str) -> str:
    return f"trim(regexp_replace({col}, '\\s+', ' ', 'g'))"


def r(expr: str, n: int = 6) -> str:
    return f"round({expr}, {n})"


def values(texts) -> str:
    return ", ".join(f"({i}, {lit(t)})" for i, t in enumerate(texts))


def intent_sql(t: str = "text") -> str:
    low = f"lower({t})"
    return f"""CASE WHEN {rx(t, K.COMPLAINT_RX)} THEN 'complaint'
 WHEN {rx(t, K.ISSUE_RX)} THEN 'technical_issue'
 WHEN {any_of(low, K.BILLING_WORDS)} AND {any_of(low, K.BILLING_FAULT_WORDS)} THEN 'billing_dispute'
 WHEN {rx(t, K.QUESTION_RX)} OR contains({t}, '?') THEN 'inquiry'
 WHEN {any_of(low, K.ACCOUNT_WORDS)} THEN 'account_management' ELSE 'general' END"""


def sentiment_sql(t: str = "text") -> str:
    neg = f"len(regexp_extract_all({t}, {lit('(?i)' + K.NEGATIVE_RX)}))"
    pos = f"len(regexp_extract_all({t}, {lit('(?i)' + K.POSITIVE_RX)}))"
    return (f"CASE WHEN {neg} >= 2 THEN 'very_negative' WHEN {neg} >= 1 THEN 'negative' "
            f"WHEN {pos} >= 2 THEN 'very_positive' WHEN {pos} >= 1 THEN 'positive' "
            "ELSE 'neutral' END")


def score_sql(intent="intent", sentiment="sentiment", high="n_high", medium="n_medium",
              customer="lower(speaker) = 'customer'") -> str:
    return f"""greatest(0::DOUBLE, least(1::DOUBLE,
  0.3::DOUBLE + ({case_map(intent, K.INTENT_WEIGHT, '0::DOUBLE')})
  + ({case_map(sentiment, K.SENTIMENT_WEIGHT, '0::DOUBLE')})
  + least({high} * 0.15::DOUBLE, 0.3::DOUBLE) + least({medium} * 0.05::DOUBLE, 0.1::DOUBLE)
  + CASE WHEN {customer} THEN 0.1::DOUBLE ELSE 0::DOUBLE END))"""


def level_sql(score: str) -> str:
    return (f"CASE WHEN {score} >= 0.7::DOUBLE THEN 'critical' WHEN {score} >= 0.4::DOUBLE "
            f"THEN 'high' WHEN {score} >= 0.2::DOUBLE THEN 'medium' ELSE 'low' END")


def products_sql(t: str = "text") -> str:
    arms = ", ".join(f"CASE WHEN {any_of(f'lower({t})', ws)} THEN {lit(n)} END"
                     for n, ws in K.PRODUCT_MENTIONS.items())
    return f"[p FOR p IN [{arms}] IF p IS NOT NULL]"


LEVEL_ORDER = ("CASE overall_importance WHEN 'critical' THEN 1 WHEN 'high' THEN 2 "
               "WHEN 'medium' THEN 3 ELSE 4 END")

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, body: str, *needs: str, recursive: bool = False):
    VIEWS[name] = (needs, body)


view("turns", f"""SELECT concat('CALL_', lpad(CAST(l.k AS VARCHAR), 6, '0')) AS call_id, l.turn AS turn_index,
 CASE WHEN l.k % 29 = 0 THEN 'agent' WHEN l.k % 17 = 0 AND l.turn = 5 THEN 'system'
  WHEN l.turn % 2 = 0 THEN 'customer' ELSE 'agent' END AS speaker,
 t.text AS text, CAST(l.turn * 10 AS DOUBLE) AS start_time,
 CAST(l.turn * 10 + 5 + l.p % 5 AS DOUBLE) AS end_time
FROM (SELECT l_orderkey AS k, l_partkey AS p, CAST(row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax,
  l_shipdate) - 1 AS INT) AS turn FROM lineitem) l
JOIN (VALUES {values(SENTENCES)}) AS t(i, text) ON t.i = (l.k * 31 + l.turn * 7 + l.p) % 24""")

view("calls", """SELECT concat('CALL_', lpad(CAST(o_orderkey AS VARCHAR), 6, '0')) AS call_id,
 concat('CLIENT_', CAST(o_custkey AS VARCHAR)) AS client_id,
 CASE c_mktsegment WHEN 'BUILDING' THEN 'retail' WHEN 'AUTOMOBILE' THEN 'premium'
  WHEN 'MACHINERY' THEN 'enterprise' WHEN 'HOUSEHOLD' THEN 'vip' ELSE 'retail' END AS client_segment,
 CASE o_orderkey % 8 WHEN 0 THEN 'retirement_fund' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'mortgage'
  WHEN 3 THEN 'etf' WHEN 4 THEN 'savings_account' WHEN 5 THEN 'loan' WHEN 6 THEN 'insurance'
  ELSE 'investment' END AS product,
 o_totalprice / 100.0::DOUBLE AS call_duration_seconds,
 o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS call_timestamp, r_name AS region,
 concat('AGENT_', CAST(100 + o_custkey % 900 AS VARCHAR)) AS agent_id,
 CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'O' THEN 'pending' ELSE 'escalated' END AS call_outcome
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey""")

view("query_log", f"""SELECT e.event_id AS query_id, e.ts AS ts, e.user_id AS user_id, t.text AS query_text,
 CASE e.event_type WHEN 'purchase' THEN 'deep' WHEN 'view' THEN 'balanced' ELSE 'cheap' END AS mode,
 e.value AS latency_ms, e.event_type = 'error' AS is_error
FROM events e JOIN (VALUES {values(QUESTIONS)}) AS t(i, text)
 ON t.i = (e.event_id * 5 + e.user_id) % 16""")

view("truth", """SELECT concat('CALL_', lpad(CAST(o_orderkey AS VARCHAR), 6, '0')) AS call_id,
 o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_important FROM orders""")

view("chat", """SELECT concat('CONV_', CAST(conv_id AS VARCHAR)) AS call_id, CAST(turn AS INT) AS turn_index,
 CASE role WHEN 'user' THEN 'customer' WHEN 'assistant' THEN 'agent' ELSE role END AS speaker, text
FROM conversations""")

view("seg", f"""SELECT *, importance_score >= 0.4::DOUBLE AS requires_llm_enrichment,
 importance_score >= 0.7::DOUBLE AS is_critical
FROM (SELECT *, {score_sql()} AS importance_score
 FROM (SELECT printf('%s_SEG_%03d', call_id, turn_index) AS segment_id, call_id, turn_index, speaker,
  text, start_time, end_time, {intent_sql()} AS intent, {sentiment_sql()} AS sentiment,
  {found('lower(text)', K.HIGH_KEYWORDS)} AS high_priority_keywords,
  {found('lower(text)', K.MEDIUM_KEYWORDS)} AS medium_priority_keywords,
  len({found('lower(text)', K.HIGH_KEYWORDS)}) AS n_high,
  len({found('lower(text)', K.MEDIUM_KEYWORDS)}) AS n_medium,
  {products_sql()} AS products_mentioned,
  {found('lower(text)', K.ISSUE_MENTIONS)} AS issues_mentioned FROM turns))""", "turns")

_ISEV = case_map("intent", K.INTENT_SEVERITY, "0")
_SSEV = case_map("sentiment", K.SENTIMENT_SEVERITY, "0")



def exact_total(x: str, where: str = "TRUE") -> str:
    """Sum of doubles in [0, 1], rounded once: their upper and lower bits are added apart, both without error."""
    up = "1073741824::DOUBLE"
    high = f"floor({x} * {up})"
    return (f"(sum({high}) FILTER (WHERE {where}) + sum({x} * {up} * {up} - {high} * {up}) FILTER (WHERE {where}) / {up}) / {up}")


view("pc", f"""SELECT *, CASE WHEN requires_enrichment THEN CASE
  WHEN overall_importance = 'critical' THEN 'Critical importance score'
  WHEN overall_intent = 'complaint' THEN 'Complaint detected'
  WHEN high_priority_segments >= 2 THEN concat(CAST(high_priority_segments AS VARCHAR), ' high-priority segments')
  END END AS enrichment_reason
FROM (SELECT *, overall_importance IN ('critical', 'high') OR high_priority_segments >= 2 AS requires_enrichment
 FROM (SELECT *, {level_sql('weighted_score')} AS overall_importance
  FROM (SELECT call_id, overall_intent, overall_sentiment, total_segments, high_priority_segments,
   s / total_segments AS importance_score,
   coalesce(c / nc, 0) * 0.7::DOUBLE + coalesce(a / na, 0) * 0.3::DOUBLE AS weighted_score
   FROM (SELECT call_id, first(intent ORDER BY {_ISEV} DESC, turn_index) AS overall_intent,
     first(sentiment ORDER BY {_SSEV} DESC, turn_index) AS overall_sentiment,
     count(*) AS total_segments, count(*) FILTER (WHERE is_critical) AS high_priority_segments,
     {exact_total('importance_score')} AS s,
     {exact_total('importance_score', "lower(speaker) = 'customer'")} AS c,
     nullif(count(*) FILTER (WHERE lower(speaker) = 'customer'), 0) AS nc,
     {exact_total('importance_score', "lower(speaker) = 'agent'")} AS a,
     nullif(count(*) FILTER (WHERE lower(speaker) = 'agent'), 0) AS na
     FROM seg GROUP BY call_id))))""", "seg")

view("enriched", "SELECT call_id FROM pc WHERE overall_importance = 'critical'", "pc")
view("both_calls", "SELECT * FROM calls JOIN pc USING (call_id)", "calls", "pc")
view("all_calls", "SELECT * FROM calls LEFT JOIN pc USING (call_id)", "calls", "pc")


def sql(body: str, *needs: str) -> str:
    """`body` preceded by the views it needs, in dependency order."""
    order: list[str] = []

    def visit(name):
        for n in VIEWS[name][0]:
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    items = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    return f"WITH RECURSIVE {items}\n{body}" if items else body
