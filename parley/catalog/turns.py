"""Ordered operators inside calls."""

from pyspark.sql import functions as F

from parley import constants as K
from parley.catalog import sql_views as V
from parley.catalog.base import query
from parley.catalog.scalars import full_clean_sql
from parley.catalog.sql_views import any_rx, lit, n_words, r, sql, view
from parley.functions import text as X
from parley.operators import summaries as M
from parley.operators import turns as O

KEY = ["call_id", "turn_index"]
ID = "SELECT call_id, turn_index::BIGINT AS turn_index"

# --- SQL views of the noise filters -----------------------------------------
_RATIO = "{c} / greatest({n} / 5.0::DOUBLE, 1::DOUBLE)"


def substantial(patterns, t="text", limit=0.5, long_enough=15):
    ratio = _RATIO.format(c=V.count_rx(t, patterns), n=n_words(t))
    return f"({ratio} < {limit}::DOUBLE OR {n_words(t)} > {long_enough})"


view("trimmed", f"""SELECT turns.* FROM turns JOIN (SELECT call_id, n,
  CASE WHEN n < 6 THEN 0 WHEN lo < 5 THEN lo ELSE 0 END AS lo,
  CASE WHEN n < 6 THEN n - 1 WHEN hi >= n - 5 THEN hi ELSE n - 1 END AS hi FROM (SELECT call_id,
   count(*) AS n, min(turn_index) FILTER (WHERE NOT {any_rx('text', K.GREETING_RX)}) AS lo,
   max(turn_index) FILTER (WHERE NOT {any_rx('text', K.GREETING_RX)}) AS hi FROM turns GROUP BY 1)) b
 USING (call_id) WHERE turn_index BETWEEN lo AND hi""", "turns")

view("trimmed_full", f"""SELECT turns.* FROM turns JOIN (SELECT call_id,
  CASE WHEN n < 6 THEN 0 ELSE least(coalesce(lo, n), 4) END AS lo,
  CASE WHEN n < 6 THEN n - 1 ELSE n - 1 - least(n - 1 - coalesce(hi, -1), 4) END AS hi FROM (SELECT call_id,
   count(*) AS n, min(turn_index) FILTER (WHERE NOT {any_rx('text', K.GREETING_FULL_RX)}) AS lo,
   max(turn_index) FILTER (WHERE NOT {any_rx('text', K.CLOSING_RX)}) AS hi FROM turns GROUP BY 1)) b
 USING (call_id) WHERE turn_index BETWEEN lo AND hi""", "turns")


def tokens_sql(t="text"):
    return f"[w FOR w IN regexp_extract_all(lower({t}), '[\\p{{L}}\\p{{N}}_]+') IF length(w) >= 2]"


def grams(t):
    return f"list_distinct([substr({t}, i, 3) FOR i IN range(1, length({t}) - 1)])"


def repetition_views(prefix, source):
    """Views `<prefix>_in` (numbered) and `<prefix>` (kept flags) by recursion."""
    view(f"{prefix}_in", f"""SELECT *, lower(speaker) AS who, {grams('text')} AS tg,
 row_number() OVER (PARTITION BY call_id, lower(speaker) ORDER BY turn_index) AS rn FROM {source}""", source)
    dup = ("len([k FOR k IN f.kept IF len(list_intersect(n.tg, k))::DOUBLE / "
           "nullif(len(list_distinct(list_concat(n.tg, k))), 0) > 0.85::DOUBLE]) > 0")
    view(f"{prefix}_rec", f"""SELECT call_id, who, rn, turn_index, [tg] AS kept, TRUE AS keep FROM {prefix}_in WHERE rn = 1
 UNION ALL SELECT n.call_id, n.who, n.rn, n.turn_index,
  CASE WHEN {dup} THEN f.kept ELSE list_append(f.kept, n.tg)[-3:] END, NOT ({dup})
 FROM {prefix}_rec f JOIN {prefix}_in n ON n.call_id = f.call_id AND n.who = f.who AND n.rn = f.rn + 1""",
         f"{prefix}_in")
    view(prefix, f"""SELECT i.* EXCLUDE (who, tg, rn) FROM {prefix}_in i JOIN {prefix}_rec f
 ON i.call_id = f.call_id AND i.turn_index = f.turn_index WHERE f.keep""", f"{prefix}_in", f"{prefix}_rec")


repetition_views("unrepeated", "turns")
_CLEAN = V.squeeze(f"regexp_replace(text, {lit('(?i)' + K.FILLER_RX)}, '', 'g')")
view("cleaned", f"SELECT * REPLACE ({_CLEAN} AS text) FROM trimmed WHERE {substantial(K.PROCEDURAL_RX)}", "trimmed")
repetition_views("cleaned_once", "cleaned")
view("filtered", f"SELECT * FROM cleaned_once WHERE {n_words('text')} >= 3", "cleaned_once")


def lag_filter(source, position):
    """Rows not similar to one of the three rows before (same speaker)."""
    sims = " OR ".join(
        f"coalesce(lag(speaker, {i}) OVER w = speaker AND len(tg) > 0 AND len(lag(tg, {i}) OVER w) > 0 AND "
        f"len(list_intersect(tg, lag(tg, {i}) OVER w))::DOUBLE / "
        f"nullif(len(list_distinct(list_concat(tg, lag(tg, {i}) OVER w))), 0) > 0.85::DOUBLE, FALSE)"
        for i in (1, 2, 3))
    return (f"SELECT * EXCLUDE (tg, is_alike) FROM (SELECT *, {sims} AS is_alike FROM "
            f"(SELECT *, {grams('text')} AS tg FROM {source}) WINDOW w AS (PARTITION BY call_id "
            f"ORDER BY {position})) WHERE NOT is_alike")


view("filtered_full", f"""SELECT * FROM ({lag_filter(f'''(SELECT * FROM (SELECT * REPLACE ({full_clean_sql()} AS text)
 FROM trimmed_full WHERE {substantial(K.PROCEDURAL_FULL_RX)}) WHERE NOT {any_rx('text', K.HOLD_RX)})''', 'turn_index')})
 WHERE {n_words('text')} >= 3""", "trimmed_full")


# --- filters ----------------------------------------------------------------
def _filter(name, fn, where):
    def run(t):
        return fn(t.turns).select(*KEY, "text")
    query(sql(f"{ID}, text FROM turns WHERE {where}", "turns"), name=name)(run)


_filter("drop_short_turns", O.drop_short_turns, f"{n_words('text')} >= 3")
_filter("filter_procedural", O.filter_procedural, substantial(K.PROCEDURAL_RX))
_filter("filter_procedural_aggressive", lambda d: O.filter_procedural(d, True),
        substantial(K.PROCEDURAL_RX, limit=0.3, long_enough=25))
_filter("drop_hold_turns", O.drop_hold_turns, f"NOT {any_rx('text', K.HOLD_RX)}")
_filter("drop_greetings_simple", O.drop_greetings_simple,
        f"NOT ({any_rx('text', K.GREETING_SIMPLE_RX)} AND {n_words('text')} <= 10)")
_filter("drop_procedural_simple", O.drop_procedural_simple,
        f"{V.count_rx('text', K.PROCEDURAL_SIMPLE_RX)} <= 1 OR {n_words('text')} > 20")


@query(sql(f"{ID}, text FROM trimmed", "trimmed"))
def trim_opening_closing(t):
    return O.trim_opening_closing(t.turns).select(*KEY, "text")


@query(sql(f"{ID}, text FROM trimmed_full", "trimmed_full"))
def trim_opening_closing_prefix(t):
    return O.trim_opening_closing_prefix(t.turns).select(*KEY, "text")


@query(sql(f"{ID}, speaker, text FROM unrepeated", "unrepeated"))
def remove_repetitions(t):
    return O.remove_repetitions(t.turns).select(*KEY, "speaker", "text")


@query(sql(f"{ID}, speaker, text FROM ({lag_filter('turns', 'turn_index')})", "turns"))
def remove_repetitions_lag(t):
    return O.remove_repetitions_lag(t.turns).select(*KEY, "speaker", "text")


# Pairs of distinct customer texts that are alike, then the fold over each call's turns.
_RARE = "pow(ln(1.5::DOUBLE) + 1, 2)"
view("customer_tf", """SELECT text, w, count(*) AS n FROM (SELECT text, unnest(""" + tokens_sql() + """) AS w
 FROM (SELECT DISTINCT text FROM turns WHERE speaker = 'customer')) GROUP BY ALL""", "turns")
view("customer_alike", f"""SELECT x, list(y) AS others FROM (SELECT a.text AS x, b.text AS y, sum(a.n * b.n) AS xy,
  sum(a.n * a.n) AS xx, sum(b.n * b.n) AS yy FROM customer_tf a JOIN customer_tf b USING (w) GROUP BY ALL)
 JOIN (SELECT text AS x, sum(n * n) AS all_x FROM customer_tf GROUP BY 1) USING (x)
 JOIN (SELECT text AS y, sum(n * n) AS all_y FROM customer_tf GROUP BY 1) USING (y)
 WHERE xy / (sqrt(xx + {_RARE} * (all_x - xx)) * sqrt(yy + {_RARE} * (all_y - yy))) > 0.8::DOUBLE GROUP BY x""",
     "customer_tf")
view("customer_in", """SELECT call_id, turn_index, speaker, text, coalesce(others, []) AS others,
 row_number() OVER (PARTITION BY call_id ORDER BY turn_index) AS rn
FROM turns LEFT JOIN customer_alike ON x = text WHERE speaker = 'customer'""", "turns", "customer_alike")
view("customer_rec", """SELECT call_id, rn, turn_index, [text] AS kept, TRUE AS keep FROM customer_in WHERE rn = 1
 UNION ALL SELECT n.call_id, n.rn, n.turn_index, CASE WHEN list_has_any(f.kept, n.others) THEN f.kept
  ELSE list_append(f.kept, n.text)[-3:] END, NOT list_has_any(f.kept, n.others)
 FROM customer_rec f JOIN customer_in n ON n.call_id = f.call_id AND n.rn = f.rn + 1""", "customer_in")


@query(sql(f"""{ID}, speaker, text FROM turns WHERE speaker <> 'customer' UNION ALL
 {ID}, speaker, text FROM customer_in JOIN customer_rec USING (call_id, turn_index) WHERE keep""",
           "turns", "customer_in", "customer_rec"))
def dedupe_customer_turns(t):
    return O.dedupe_customer_turns(t.turns).select(*KEY, "speaker", "text")


@query(sql("""SELECT call_id, run, 0::BIGINT AS part, speaker, string_agg(text, ' ' ORDER BY turn_index) AS run_text
FROM (SELECT *, sum(is_new) OVER (PARTITION BY call_id ORDER BY turn_index)::BIGINT AS run FROM (
 SELECT *, CASE WHEN lag(speaker) OVER (PARTITION BY call_id ORDER BY turn_index) = speaker THEN 0 ELSE 1 END
 AS is_new FROM turns)) GROUP BY call_id, run, speaker""", "turns"))
def speaker_runs(t):
    return O.speaker_runs(t.turns)


@query(sql("""SELECT call_id, run, speaker, count(*) AS n_turns, sum(length(text))::BIGINT AS n_chars
FROM (SELECT *, sum(is_new) OVER (PARTITION BY call_id ORDER BY turn_index)::BIGINT AS run FROM (
 SELECT *, CASE WHEN lag(speaker) OVER (PARTITION BY call_id ORDER BY turn_index) = speaker THEN 0 ELSE 1 END
 AS is_new FROM chat)) GROUP BY call_id, run, speaker""", "chat"))
def speaker_runs_chat(t):
    """Runs in the multilingual chats, measured without the joining blanks."""
    runs = O.speaker_runs(t.chat_turns.withColumn("text", F.length("text").cast("string")))
    sizes = F.split("run_text", " ").cast("array<bigint>")
    return runs.select("call_id", "run", "speaker", F.size(sizes).alias("n_turns"),
                       F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x)
                       .alias("n_chars"))


# --- selection --------------------------------------------------------------
def greedy_views(prefix, source, target, score="score"):
    """`<prefix>`: rows of `source` taken greedily by score within `target` words."""
    view(f"{prefix}_in", f"""SELECT *, {n_words('text')} AS nw, row_number() OVER (PARTITION BY call_id
 ORDER BY {score} DESC, turn_index) AS rn FROM {source}""", source)
    view(f"{prefix}_rec", f"""SELECT call_id, rn, turn_index, CASE WHEN nw <= {target} THEN nw ELSE 0 END AS used,
  nw <= {target} AS taken FROM {prefix}_in WHERE rn = 1
 UNION ALL SELECT n.call_id, n.rn, n.turn_index, CASE WHEN f.used + n.nw <= {target} THEN f.used + n.nw ELSE f.used END,
  f.used + n.nw <= {target} FROM {prefix}_rec f JOIN {prefix}_in n ON n.call_id = f.call_id AND n.rn = f.rn + 1""",
         f"{prefix}_in")
    view(prefix, f"""SELECT i.* EXCLUDE (nw, rn) FROM {prefix}_in i JOIN {prefix}_rec f USING (call_id, turn_index)
 WHERE f.taken""", f"{prefix}_in", f"{prefix}_rec")


view("seg_scored", "SELECT * EXCLUDE (importance_score), round(importance_score, 6) AS score FROM seg", "seg")
greedy_views("important20", "seg_scored", 20)
greedy_views("important2000", "seg_scored", 2000)


@query(sql(f"{ID}, {r('score')} AS score FROM important20", "important20"))
def extractive_select(t):
    """A tight budget of 20 words, so that turns are skipped."""
    scored = t.segments.withColumn("score", F.round("importance_score", 6))
    return O.extractive_select(scored, 20).select(*KEY, "score")


@query(sql(f"{ID}, {r('score')} AS score FROM important2000", "important2000"))
def importance_chunk(t):
    return M.importance_chunk(t.turns).select(*KEY, "score")


@query(sql(f"""SELECT query_text, rank, segment_id FROM (SELECT query_text, rank, segment_id,
 sum(tokens) OVER (PARTITION BY query_text ORDER BY rank) AS used FROM (
 SELECT overall_intent AS query_text, segment_id, (length(text) // 4)::BIGINT AS tokens,
  row_number() OVER (PARTITION BY overall_intent ORDER BY round(seg.importance_score, 6) DESC, segment_id) AS rank
 FROM seg JOIN pc USING (call_id)) WHERE rank <= 50) WHERE used <= 100""", "seg", "pc"))
def context_budget(t):
    """The 50 most important segments per call intent, within 100 tokens."""
    rows = t.segments.withColumn("score", F.round("importance_score", 6)).join(
        t.pc.select("call_id", F.col("overall_intent").alias("query_text")), "call_id")
    ranked = O.rank_results(rows, ["query_text"], "score", "segment_id", 50)
    return O.context_budget(ranked, ["query_text"], "rank", X.approx_tokens(F.col("text")),
                            100).select("query_text", "rank", "segment_id")


# --- chunking ---------------------------------------------------------------
def _chunks_sql(size, overlap):
    return f"""SELECT doc_id, i AS chunk_index,
 array_to_string(w[i * {size - overlap} + 1 : i * {size - overlap} + {size}], ' ') AS chunk_text
FROM (SELECT doc_id, w, unnest(range(0, (len(w) - 1) // {size - overlap} + 1)) AS i FROM (
 SELECT doc_id, string_split({V.squeeze('text')}, ' ') AS w FROM documents WHERE {V.squeeze('text')} <> ''))"""


@query(sql(_chunks_sql(1000, 0)))
def fixed_chunks(t):
    return O.fixed_chunks(t.table("documents"), "doc_id", size=1000)


@query(sql(_chunks_sql(500, 50)))
def fixed_chunks_overlap(t):
    return O.fixed_chunks(t.table("documents"), "doc_id", size=500, overlap=50)


@query(sql(f"""{ID}, round(gap, 6) AS gap_seconds, coalesce(gap > 5, FALSE) AS is_pause FROM (
 SELECT *, start_time - lag(end_time) OVER (PARTITION BY call_id ORDER BY turn_index) AS gap FROM turns)""", "turns"))
def pause_gap(t):
    return O.pause_gap(t.turns).select(*KEY, "gap_seconds", "is_pause")


def vector_views(prefix, source, key, text):
    """`<prefix>`: hashed unit vectors of distinct texts as (key, slot, x)."""
    view(f"{prefix}_n", f"""SELECT k, slot, count(*) AS n FROM (SELECT k,
 ('0x' || substr(md5(w), 1, 8))::BIGINT % {K.EMBEDDING_DIM} AS slot FROM (SELECT k, unnest({tokens_sql('t')}) AS w
  FROM (SELECT {key} AS k, {text} AS t FROM {source}))) GROUP BY ALL""", source)
    view(prefix, f"""SELECT k, slot, n / sqrt(sum(n * n) OVER (PARTITION BY k))::DOUBLE AS x FROM {prefix}_n""",
         f"{prefix}_n")


view("next_texts", """SELECT *, lead(text) OVER (PARTITION BY call_id ORDER BY {p}) AS next_text,
 {p} AS pos FROM {s}""".format(p="turn_index", s="turns"), "turns")
view("distinct_texts", "SELECT DISTINCT text FROM turns", "turns")
vector_views("text_vec", "distinct_texts", "text", "text")
view("adjacent", """SELECT t.*, CASE WHEN next_text IS NOT NULL THEN coalesce(sim, 0::DOUBLE) END AS sim FROM next_texts t
 LEFT JOIN (SELECT a.k AS ka, b.k AS kb, round(sum(a.x * b.x), 6) AS sim FROM text_vec a JOIN text_vec b
  ON a.slot = b.slot GROUP BY ALL) s ON s.ka = t.text AND s.kb = t.next_text""", "next_texts", "text_vec")
view("topics", f"""SELECT *, coalesce(sum(closes) OVER (PARTITION BY call_id ORDER BY turn_index
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS segment FROM (SELECT *,
  CASE WHEN next_text IS NOT NULL AND (sim < 0.6::DOUBLE OR {V.rx('text', K.TOPIC_MARKER_RX)}) THEN 1 ELSE 0 END
  AS closes FROM adjacent)""", "adjacent")
view("chunked", """SELECT *, coalesce(sum(low) OVER (PARTITION BY call_id ORDER BY turn_index
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS segment FROM (SELECT *,
  CASE WHEN lead(sim, 3) OVER w IS NOT NULL AND round((sim + lead(sim, 1) OVER w + lead(sim, 2) OVER w) / 3, 6)
   < 0.65::DOUBLE THEN 1 ELSE 0 END AS low FROM adjacent WINDOW w AS (PARTITION BY call_id ORDER BY turn_index))""",
     "adjacent")


@query(sql(f"{ID}, segment FROM topics", "topics"))
def topic_boundaries(t):
    return O.topic_boundaries(t.turns).select(*KEY, "segment")


@query(sql(f"{ID}, segment FROM chunked", "chunked"))
def semantic_chunks(t):
    return O.semantic_chunks(t.turns).select(*KEY, "segment")


view("topic_table", f"""SELECT call_id, segment, min(topics.turn_index) AS first_turn, max(topics.turn_index) AS last_turn,
 sum({n_words('topics.text')})::BIGINT AS n_words, max(importance_score) AS importance_score,
 min(topics.start_time) AS start_time, max(topics.end_time) AS end_time
FROM topics JOIN (SELECT call_id, turn_index, importance_score FROM seg) s USING (call_id, turn_index)
GROUP BY ALL""", "topics", "seg")


@query(sql(f"SELECT call_id, segment, {r('importance_score')} AS importance_score FROM topic_table", "topic_table"))
def segment_importance(t):
    scores = t.segments.select(*KEY, "importance_score")
    rows = O.topic_boundaries(t.turns).join(scores, KEY)
    return O.segment_table(rows, F.col("importance_score")).select("call_id", "segment",
                                                                   "importance_score")


view("merge_rec", """SELECT call_id, segment, n_words AS used, 0::BIGINT AS chunk FROM topic_table WHERE segment = 0
 UNION ALL SELECT n.call_id, n.segment, CASE WHEN f.used + n.n_words <= 25 THEN f.used + n.n_words ELSE n.n_words END,
 CASE WHEN f.used + n.n_words <= 25 THEN f.chunk ELSE f.chunk + 1 END
 FROM merge_rec f JOIN topic_table n ON n.call_id = f.call_id AND n.segment = f.segment + 1""", "topic_table")


@query(sql("""SELECT call_id, chunk, min(first_turn)::BIGINT AS first_turn, max(last_turn)::BIGINT AS last_turn,
 sum(n_words)::BIGINT AS n_words, min(start_time) AS start_time, max(end_time) AS end_time
FROM topic_table JOIN merge_rec USING (call_id, segment) GROUP BY call_id, chunk""", "topic_table", "merge_rec"))
def merge_small_segments(t):
    """Topic segments packed into at most 25 words."""
    table = O.segment_table(O.topic_boundaries(t.turns))
    return O.merged_segments(O.merge_small_segments(table, 25)).drop("importance_score")


view("phases", f"""SELECT turns.*, n AS n_turns, CASE WHEN turn_index / n::DOUBLE < 0.1::DOUBLE THEN 'opening'
 WHEN turn_index / n::DOUBLE > 0.85::DOUBLE THEN 'closing' WHEN {any_rx('text', K.RESOLUTION_RX)} THEN 'resolution'
 ELSE 'investigation' END AS phase FROM turns JOIN (SELECT call_id, count(*) AS n FROM turns GROUP BY 1) USING (call_id)""",
     "turns")


@query(sql(f"{ID}, phase FROM phases", "phases"))
def call_phases(t):
    return O.call_phases(t.turns).select(*KEY, "phase")


@query(sql(f"{ID}, text FROM phases WHERE phase IN ('opening', 'investigation')", "phases"))
def issue_phases(t):
    return O.call_phases(t.turns).filter(F.col("phase").isin("opening", "investigation")).select(
        *KEY, "text")


@query(sql("""SELECT call_id, segment, concat_ws('_', max(word) FILTER (WHERE rk = 1), max(word) FILTER (WHERE rk = 2)) AS topic
FROM (SELECT *, row_number() OVER (PARTITION BY call_id, segment ORDER BY n DESC, first_turn, first_at) AS rk FROM (
 SELECT call_id, segment, word, count(*) AS n, min(turn_index) AS first_turn,
  min(turn_index * 100000 + wi) AS first_at FROM (
  SELECT call_id, segment, turn_index, unnest(w) AS word, unnest(range(0, len(w))) AS wi FROM (
   SELECT *, regexp_split_to_array(lower(text), '\\s+') AS w FROM topics))
 WHERE regexp_matches(word, '^\\p{L}{5,}$') GROUP BY ALL)) GROUP BY call_id, segment""", "topics"))
def topic_label(t):
    return O.topic_label(O.topic_boundaries(t.turns))


@query(sql(f"""SELECT overall_intent, call_id, rank FROM (SELECT overall_intent, call_id,
 row_number() OVER (PARTITION BY overall_intent ORDER BY round(importance_score, 6) DESC, call_id) AS rank FROM pc)""",
           "pc"))
def rank_results(t):
    rows = t.pc.withColumn("score", F.round("importance_score", 6))
    return O.rank_results(rows, ["overall_intent"], "score", "call_id").select(
        "overall_intent", "call_id", "rank")


@query(sql(f"""SELECT overall_intent, call_id, rank FROM (SELECT overall_intent, call_id,
 row_number() OVER (PARTITION BY overall_intent ORDER BY round(importance_score, 6) DESC, call_id) AS rank FROM pc)
WHERE rank <= 10""", "pc"))
def top_k_per_query(t):
    rows = t.pc.withColumn("score", F.round("importance_score", 6))
    return O.rank_results(rows, ["overall_intent"], "score", "call_id", 10).select(
        "overall_intent", "call_id", "rank")


@query(sql(f"""SELECT call_id, turn_index::BIGINT AS turn_index, to_json(list_sort({grams('text')}))::VARCHAR AS grams,
 len({grams('text')})::BIGINT AS n_grams FROM chat""", "chat"))
def trigram_sets(t):
    g = X.trigrams(F.col("text"))
    return t.chat_turns.select(*KEY, F.array_sort(g).alias("grams"), F.size(g).alias("n_grams"))
