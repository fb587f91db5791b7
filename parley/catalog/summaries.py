"""Summarisation over whole calls."""

from pyspark.sql import functions as F

from parley import constants as K
from parley.catalog import sql_views as V
from parley.catalog import turns as TU
from parley.catalog.base import query
from parley.catalog.sql_views import any_of, any_rx, n_words, r, sql, view
from parley.operators import summaries as M
from parley.plans.workspace import written
from parley.sources.transcripts import assemble_transcript

KEY = ["call_id", "turn_index"]
ID = "SELECT call_id, turn_index::BIGINT AS turn_index"
STOP = V.words(K.STOP_WORDS)


def kept_tokens(t="text"):
    return f"[w FOR w IN {TU.tokens_sql(t)} IF NOT list_contains({STOP}, w)]"


def tfidf_views(prefix, source, keys="call_id", index="turn_index", features=100, min_max=False):
    """`<prefix>`: rows of `source` with `tfidf_score` inside each group."""
    k = [x.strip() for x in keys.split(",")]
    view(f"{prefix}_tf", f"""SELECT {keys}, {index}, term, count(*) AS tf FROM (SELECT {keys}, {index},
 unnest({kept_tokens()}) AS term FROM {source}) GROUP BY ALL""", source)
    view(f"{prefix}_idf", f"""SELECT {keys}, term, ln((n + 1) / (df + 1)::DOUBLE) + 1 AS idf FROM (SELECT *,
  row_number() OVER (PARTITION BY {keys} ORDER BY total DESC, term) AS rk FROM (SELECT {keys}, term,
   sum(tf) AS total, count(*) AS df FROM {prefix}_tf GROUP BY ALL))
 JOIN (SELECT {keys}, count(*) AS n FROM {source} GROUP BY ALL) USING ({keys}) WHERE rk <= {features}""",
         f"{prefix}_tf")
    view(f"{prefix}_sum", f"""SELECT s.*, CASE WHEN h.{k[0]} IS NULL THEN NULL ELSE coalesce(rs, 0::DOUBLE) END AS row_sum
 FROM {source} s LEFT JOIN (SELECT {keys}, {index}, round(sum(tf * idf) / sqrt(sum(tf * idf * tf * idf)), 12) AS rs
  FROM {prefix}_tf JOIN {prefix}_idf USING ({keys}, term) GROUP BY ALL) USING ({keys}, {index})
 LEFT JOIN (SELECT DISTINCT {keys} FROM {prefix}_idf) h USING ({keys})""", f"{prefix}_idf")
    hi, lo = (f"{f}(row_sum) OVER (PARTITION BY {keys})" for f in ("max", "min"))
    scaled = (f"(row_sum - {lo}) / ({hi} - {lo} + 1e-10::DOUBLE)" if min_max
              else f"row_sum / ({hi} + 1e-10::DOUBLE)")
    view(prefix, f"""SELECT * EXCLUDE (row_sum), round(coalesce({scaled}, 0.5::DOUBLE), 9) AS tfidf_score
 FROM {prefix}_sum""", f"{prefix}_sum")


CUSTOMER = "CASE WHEN lower(speaker) = 'customer' THEN {}::DOUBLE ELSE 0::DOUBLE END"
SALIENCE = (f"round(tfidf_score * 0.5::DOUBLE + {CUSTOMER.format(0.3)} + CASE WHEN "
            f"{any_of('lower(text)', K.NEGATIVE_WORDS)} THEN 0.2::DOUBLE ELSE 0::DOUBLE END, 6)")
tfidf_views("turn_tfidf", "turns")
tfidf_views("filtered_tfidf", "filtered")
view("salient", f"SELECT *, {SALIENCE} AS score FROM filtered_tfidf", "filtered_tfidf")
TU.greedy_views("chosen500", "salient", 500)
TU.greedy_views("chosen15", "salient", 15)


def summary_view(prefix, chosen):
    view(prefix, f"""SELECT call_id, coalesce(summary, '{K.NO_CONTENT}') AS summary FROM (SELECT DISTINCT call_id FROM turns)
 LEFT JOIN (SELECT call_id, string_agg(CASE WHEN is_new THEN concat(speaker, ': ', text) ELSE text END, ' '
  ORDER BY turn_index) AS summary FROM (SELECT *, coalesce(lag(speaker) OVER (PARTITION BY call_id ORDER BY turn_index)
   <> speaker, TRUE) AS is_new FROM {chosen}) GROUP BY call_id) USING (call_id)""", "turns", chosen)


summary_view("fast_summary", "chosen500")
summary_view("tight_summary", "chosen15")


@query(sql(f"{ID}, speaker, text FROM filtered", "filtered"))
def noise_filter(t):
    return M.noise_filter(t.turns).select(*KEY, "speaker", "text")


@query(sql(f"{ID}, speaker, text FROM filtered_full", "filtered_full"))
def noise_filter_full(t):
    return M.noise_filter_full(t.turns).select(*KEY, "speaker", "text")


@query(sql(f"""SELECT call_id, original_turns, original_tokens, filtered_turns, filtered_tokens,
 {r('(1 - filtered_tokens / nullif(original_tokens, 0)::DOUBLE) * 100')} AS noise_removed_pct,
 {r('(1 - filtered_turns / nullif(original_turns, 0)::DOUBLE) * 100')} AS turn_reduction_pct FROM (
 SELECT call_id, count(*) AS original_turns, sum({n_words('turns.text')})::BIGINT AS original_tokens,
  count(f.text) AS filtered_turns, coalesce(sum({n_words('f.text')}) FILTER (WHERE f.text IS NOT NULL), 0)::BIGINT AS filtered_tokens
 FROM turns LEFT JOIN filtered f USING (call_id, turn_index) GROUP BY 1)""", "turns", "filtered"))
def noise_reduction_stats(t):
    return M.noise_reduction_stats(t.turns, M.noise_filter(t.turns))


@query(sql(f"{ID}, round(tfidf_score, 6) AS tfidf_score FROM turn_tfidf", "turn_tfidf"))
def turn_tfidf_score(t):
    return M.turn_tfidf_score(t.turns).select(*KEY, "tfidf_score")


tfidf_views("chat_tfidf", "chat")


@query(sql(f"{ID}, round(tfidf_score, 6) AS tfidf_score FROM chat_tfidf", "chat_tfidf"))
def turn_tfidf_score_chat(t):
    return M.turn_tfidf_score(t.chat_turns).select(*KEY, "tfidf_score")


@query(sql(f"{ID}, {SALIENCE} AS score FROM turn_tfidf", "turn_tfidf"))
def turn_salience(t):
    return M.turn_salience(t.turns).select(*KEY, "score")


_KI = (f"least(len({V.found('lower(text)', K.IMPORTANT_WORDS)}) * 0.3::DOUBLE "
       f"+ len({V.found('lower(text)', K.USEFUL_WORDS)}) * 0.1::DOUBLE, 1::DOUBLE)")


def multi_sql(position, total):
    return f"""round(tfidf_score * 0.3::DOUBLE
 + (1::DOUBLE - abs(0.5::DOUBLE - {position} / {total}::DOUBLE) * 2::DOUBLE) * 0.15::DOUBLE + {CUSTOMER.format(0.2)}
 + CASE WHEN {n_words('text')} BETWEEN 5 AND 40 THEN 0.1::DOUBLE ELSE 0::DOUBLE END + {_KI} * 0.15::DOUBLE
 + CASE WHEN {any_of('lower(text)', K.NEGATIVE_WORDS_MULTI)} THEN 0.1::DOUBLE ELSE 0::DOUBLE END, 6)"""


tfidf_views("turn_minmax", "turns", features=1000, min_max=True)


@query(sql(f"{ID}, {multi_sql('turn_index', 'count(*) OVER (PARTITION BY call_id)')} AS score FROM turn_minmax",
           "turn_minmax"))
def turn_salience_multi(t):
    return M.turn_salience_multi(t.turns).select(*KEY, "score")


@query(sql("SELECT call_id, 0::BIGINT AS part, summary FROM fast_summary", "fast_summary"))
def extractive_summary(t):
    return M.extractive_summary(t.stored_turns, "fast")


@query(sql("SELECT call_id, 0::BIGINT AS part, summary FROM tight_summary", "tight_summary"))
def extractive_summary_tight(t):
    """A budget of 15 words, so that turns have to be left out."""
    return M.extractive_summary(t.stored_turns, target=15)


@query(sql(f"""SELECT call_id, original_turns, original_tokens, filtered_turns, filtered_tokens,
 {r('(1 - filtered_tokens / nullif(original_tokens, 0)::DOUBLE) * 100')} AS noise_removed_pct,
 final_turns, extracted_tokens, final_tokens, {r('final_tokens / nullif(original_tokens, 0)::DOUBLE')} AS compression_ratio
FROM (SELECT call_id, count(*) AS original_turns, sum({n_words('turns.text')})::BIGINT AS original_tokens,
  count(f.text) AS filtered_turns, coalesce(sum({n_words('f.text')}) FILTER (WHERE f.text IS NOT NULL), 0)::BIGINT AS filtered_tokens,
  count(c.text) AS final_turns, coalesce(sum({n_words('c.text')}) FILTER (WHERE c.text IS NOT NULL), 0)::BIGINT AS extracted_tokens
 FROM turns LEFT JOIN filtered f USING (call_id, turn_index) LEFT JOIN chosen15 c USING (call_id, turn_index) GROUP BY 1)
JOIN (SELECT call_id, {n_words('summary')} AS final_tokens FROM tight_summary) USING (call_id)""",
           "turns", "filtered", "chosen15", "tight_summary"))
def summary_metrics(t):
    return M.summary_metrics(t.stored_turns, target=15)


@query()
def hierarchical_summary(t):
    return M.hierarchical_summary(t.turns, max_words=25, per_segment=20)


@query()
def hierarchical_final(t):
    return M.final_summary(M.hierarchical_summary(t.turns))


def _phase(names, k):
    return (f"coalesce(string_agg(text, ' ' ORDER BY turn_index) FILTER (WHERE part = '{names}' AND rk <= {k}), '')")


@query(sql(f"""SELECT call_id, concat('Issue: ', {_phase('issue', 2)}, chr(10), 'Resolution: ', {_phase('resolution', 2)},
 chr(10), 'Outcome: ', {_phase('outcome', 1)}) AS summary FROM (SELECT *, row_number() OVER (PARTITION BY call_id, part
 ORDER BY round(importance_score, 6) DESC, turn_index) AS rk FROM (SELECT phases.call_id, phases.turn_index, phases.text,
  importance_score, CASE phase WHEN 'resolution' THEN 'resolution' WHEN 'closing' THEN 'outcome' ELSE 'issue' END AS part
  FROM phases JOIN (SELECT call_id, turn_index, importance_score FROM seg) USING (call_id, turn_index))) GROUP BY call_id""",
           "phases", "seg"))
def phase_summary(t):
    return M.phase_summary(t.turns)


def _pairs(t):
    reference = assemble_transcript(t.stored_turns).filter("part = 0").select(
        "call_id", F.col("transcript_text").alias("reference"))
    return written(M.extractive_summary(t.stored_turns, target=15).join(reference, "call_id"), "pairs")


view("rouge_pairs", """SELECT call_id, summary, reference FROM tight_summary JOIN (SELECT call_id,
 string_agg(concat(upper(speaker), ': ', text), chr(10) ORDER BY turn_index) AS reference FROM turns GROUP BY 1)
 USING (call_id)""", "tight_summary", "turns")


def _rouge(n, name):
    grams = lambda c: (TU.tokens_sql(c) if n == 1 else
                       f"[w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]")
    side = lambda c: (f"SELECT call_id, unnest({grams(c)}) AS g FROM "
                      f"(SELECT call_id, {c}, {TU.tokens_sql(c)} AS w FROM rouge_pairs)")

    def run(t):
        return M.rouge_n(_pairs(t), "call_id", n)
    query(sql(f"""SELECT call_id, {r('coalesce(p, 0)')} AS "precision", {r('coalesce(c, 0)')} AS recall,
 {r('coalesce(2 * p * c / nullif(p + c, 0), 0)')} AS f1 FROM (
 SELECT call_id, sum(least(s, q)) / nullif(sum(s), 0)::DOUBLE AS p, sum(least(s, q)) / nullif(sum(q), 0)::DOUBLE AS c
 FROM (SELECT call_id, g, count(*) FILTER (WHERE src = 's') AS s, count(*) FILTER (WHERE src = 'r') AS q FROM (
  SELECT *, 's' AS src FROM ({side('summary')}) UNION ALL SELECT *, 'r' FROM ({side('reference')})) GROUP BY ALL)
 GROUP BY call_id)""", "rouge_pairs"), name=name)(run)


_rouge(1, "rouge_1")
_rouge(2, "rouge_2")


@query()
def rouge_l(t):
    return M.rouge_l(_pairs(t), "call_id")


def _facts(c):
    return (f"list_concat([concat('product:', p) FOR p IN {V.products_sql(c)}], "
            f"[concat('issue:', i) FOR i IN {V.found(f'lower({c})', K.ISSUE_MENTIONS)}])")


@query(sql(f"""SELECT call_id, count(*) AS n_facts, count(s.fact) AS n_covered, {r('count(s.fact) / count(*)')} AS coverage
FROM (SELECT DISTINCT call_id, unnest({_facts('text')}) AS fact FROM turns) o
LEFT JOIN (SELECT DISTINCT call_id, unnest({_facts('summary')}) AS fact FROM tight_summary) s USING (call_id, fact)
GROUP BY call_id""", "turns", "tight_summary"))
def coverage(t):
    return M.coverage(t.stored_turns, M.extractive_summary(t.stored_turns, target=15))


view("stored", """SELECT call_id, 'fast' AS quality, call_timestamp + INTERVAL (d) DAY AS created_at
FROM calls, (VALUES (0), (20), (400)) AS v(d)""", "calls")


@query(sql("""SELECT call_id, requested_at, reused, count(*) AS n FROM (SELECT call_id, requested_at,
 EXISTS (SELECT 1 FROM stored s WHERE s.call_id = a.call_id AND requested_at >= created_at
         AND requested_at < created_at + INTERVAL '30' DAY) AS reused
 FROM (SELECT concat('CALL_', lpad(CAST(l_orderkey AS VARCHAR), 6, '0')) AS call_id, l_shipdate AS requested_at FROM lineitem) a) GROUP BY ALL""",
           "stored"))
def summary_reuse(t):
    """Summaries were stored three times per call; every shipped line asks for one."""
    days = F.explode(F.array(*[F.make_dt_interval(F.lit(d)) for d in (0, 20, 400)]))
    stored = t.calls.select("call_id", "call_timestamp", F.lit("fast").alias("quality"),
                            days.alias("later")).select(
        "call_id", "quality", (F.col("call_timestamp") + F.col("later")).alias("created_at"))
    asked = t.table("lineitem").select(
        F.concat(F.lit("CALL_"), F.lpad(F.col("l_orderkey").cast("string"), 6, "0"))
        .alias("call_id"), F.lit("fast").alias("quality"),
        F.col("l_shipdate").alias("requested_at"))
    return M.summary_reuse(asked, stored).groupBy("call_id", "requested_at", "reused").agg(
        F.count(F.lit(1)).alias("n"))


view("sentences", f"""SELECT call_id, speaker, {V.squeeze('s')} AS text, row_number() OVER (PARTITION BY call_id
 ORDER BY turn_index, si) - 1 AS pos FROM (SELECT call_id, turn_index, speaker, unnest(l) AS s,
 unnest(range(0, len(l))) AS si FROM (SELECT *, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'),
 chr(10)) AS l FROM chat)) WHERE {V.squeeze('s')} <> ''""", "chat")
view("plain_sentences", f"""SELECT * FROM sentences WHERE NOT {any_rx('text', K.GREETING_RX)}
 AND NOT {any_rx('text', K.PROCEDURAL_RX)}""", "sentences")
tfidf_views("sentence_tfidf", "plain_sentences", index="pos", features=1000)


@query(sql(f"""SELECT call_id, pos, speaker, text, score FROM (SELECT *, row_number() OVER (PARTITION BY call_id
 ORDER BY score DESC, pos) AS rk FROM (SELECT *, round(tfidf_score + (1::DOUBLE - abs(0.5::DOUBLE - pos /
 (max(pos) OVER (PARTITION BY call_id) + 1)::DOUBLE) * 2::DOUBLE) + {CUSTOMER.format(0.3)}
 + CASE WHEN {any_of('lower(text)', K.HIGH_KEYWORDS)} THEN 0.5::DOUBLE ELSE 0::DOUBLE END
 + CASE WHEN {any_of('lower(text)', K.NEGATIVE_WORDS)} THEN 0.2::DOUBLE ELSE 0::DOUBLE END, 6) AS score
 FROM sentence_tfidf)) WHERE rk <= 10""", "sentence_tfidf"))
def importance_sentences(t):
    return M.importance_sentences(t.chat_turns)
