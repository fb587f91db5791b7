"""Enrichment planning, prompts, results and costs."""

from pyspark.sql import functions as F

from parley import constants as K
from parley.catalog import turns as TU                                    # noqa: F401 (views)
from parley.catalog import summaries as SU                                # noqa: F401 (views)
from parley.catalog.base import query
from parley.catalog.sql_views import any_rx, lit, r, sql, view
from parley.operators import calls as C
from parley.operators import enrichment as N
from parley.operators.search import build_search_documents as build
from parley.plans.workspace import new_path, written
from parley.sources.stored import StoredTable

# --- SQL views --------------------------------------------------------------
view("plan", """SELECT call_id, overall_importance, CASE WHEN overall_importance = 'critical'
 THEN 'gpt-4-turbo-preview' ELSE 'gpt-3.5-turbo' END AS model FROM pc
WHERE requires_enrichment AND call_id NOT IN (SELECT call_id FROM enriched)""", "pc", "enriched")
view("first_plan", "SELECT call_id, 'gpt-4-turbo-preview' AS model FROM enriched", "enriched")
view("transcript_text", """SELECT call_id, string_agg(concat(upper(speaker), ': ', text), chr(10) ORDER BY turn_index) AS t
FROM turns GROUP BY call_id""", "turns")
_TASKS = ", ".join(f"({lit(k)}, {lit(head)}, {lit(tail)}, {n})" for k, (head, tail, n) in N.TASKS.items())
_PROMPT = "concat(head, chr(10), chr(10), 'Call transcript:', chr(10), t, chr(10), chr(10), tail)"


def prompt_sql(plan):
    return (f"SELECT call_id, model, task, max_tokens, {_PROMPT} AS prompt FROM {plan} JOIN transcript_text USING (call_id), "
            f"(VALUES {_TASKS}) AS x(task, head, tail, max_tokens)")


view("tags", """SELECT call_id, coalesce(list_sort(list(DISTINCT i) FILTER (WHERE i IS NOT NULL)), []) AS issues,
 coalesce(list_sort(list(DISTINCT p) FILTER (WHERE p IS NOT NULL)), []) AS products FROM (
 SELECT call_id, unnest(issues_mentioned) AS i, NULL AS p FROM seg
 UNION ALL SELECT call_id, NULL, unnest(products_mentioned) FROM seg) GROUP BY call_id""", "seg")
view("actions", f"""SELECT call_id, list(text ORDER BY turn_index) AS actions FROM turns
WHERE {any_rx('text', K.RESOLUTION_RX)} GROUP BY call_id""", "turns")


def output_views(prefix, plan):
    view(f"{prefix}_prompts", prompt_sql(plan), plan, "transcript_text")
    view(f"{prefix}_outputs", """SELECT call_id, model, task, prompt, output, (length(prompt) // 4)::BIGINT AS tin,
  (length(output) // 4)::BIGINT AS tout FROM (SELECT p.*, CASE task WHEN 'summary' THEN summary
  WHEN 'key_issues' THEN to_json(coalesce(issues, []))::VARCHAR WHEN 'action_items' THEN to_json(coalesce(actions, []))::VARCHAR
  ELSE to_json(list_concat(coalesce(issues, []), coalesce(products, [])))::VARCHAR END AS output
 FROM {0}_prompts p JOIN fast_summary USING (call_id) LEFT JOIN tags USING (call_id) LEFT JOIN actions USING (call_id))"""
         .format(prefix), f"{prefix}_prompts", "fast_summary", "tags", "actions")
    view(f"{prefix}_ledger", """SELECT *, (tin / 1000.0::DOUBLE) * CASE WHEN contains(model, 'gpt-4') THEN 0.01::DOUBLE ELSE 0.0015::DOUBLE END
 + (tout / 1000.0::DOUBLE) * CASE WHEN contains(model, 'gpt-4') THEN 0.03::DOUBLE ELSE 0.002::DOUBLE END AS cost
 FROM {0}_outputs""".format(prefix), f"{prefix}_outputs")


output_views("q", "plan")
output_views("f", "first_plan")


view("enr", """SELECT concat(call_id, '_ENRICH') AS enrichment_id, call_id, summary, coalesce(issues, []) AS key_issues,
 coalesce(actions, []) AS actions, list_concat(coalesce(issues, []), coalesce(products, [])) AS tags,
 model_used, tokens_used, cost_usd, CASE WHEN model_used = 'gpt-4-turbo-preview' THEN 0.85::DOUBLE ELSE 0.75::DOUBLE END AS confidence_score
FROM (SELECT call_id, max(model) AS model_used, sum(tin + tout)::BIGINT AS tokens_used, round(sum(cost::DECIMAL(30, 12)), 4)::DOUBLE AS cost_usd
 FROM f_ledger GROUP BY call_id) JOIN fast_summary USING (call_id) LEFT JOIN tags USING (call_id) LEFT JOIN actions USING (call_id)""",
     "f_ledger", "fast_summary", "tags", "actions")


# --- queries ----------------------------------------------------------------
def _plan(t):
    return N.plan_enrichment(t.pc, t.enriched)


def _outputs(t):
    return N.model_outputs(t.turns, _plan(t))


@query(sql("SELECT call_id, overall_importance, model FROM plan", "plan"))
def plan_enrichment(t):
    return _plan(t)


@query(sql("""SELECT call_id, 0::BIGINT AS part, model, task, prompt, max_tokens::BIGINT AS max_tokens FROM q_prompts""",
           "q_prompts"))
def render_prompts(t):
    return N.render_prompts(t.turns, _plan(t))


@query(sql(f"""SELECT call_id, 0::BIGINT AS part, task, model, output, tin AS input_tokens, tout AS output_tokens, {r('cost * 1000000')} AS cost_micro_usd
FROM q_ledger""", "q_ledger"))
def apply_model(t):
    """The rule backend's output for every prompt."""
    return _outputs(t).select("call_id", "part", "task", "model", "output", "input_tokens",
                              "output_tokens", (F.col("cost") * 1000000).alias("cost_micro_usd"))


@query(sql("""SELECT call_id, model, task, length(prompt)::BIGINT AS n_chars, 'echo ' || task AS output,
 NULL::VARCHAR AS error FROM (SELECT * FROM q_prompts)""", "q_prompts"))
def apply_model_hook(t):
    """A user function per Arrow batch in place of a model; here it names the task."""
    return N.apply_model(N.render_prompts(t.turns, _plan(t)), _echo()).select(
        "call_id", "model", "task", F.length("prompt").alias("n_chars"), "output", "error")


def _echo():
    names = {head.split("\n")[0]: task for task, (head, _, _) in N.TASKS.items()}

    def complete(texts, models, limits):
        return ["echo " + names[x.split("\n")[0]] for x in texts]
    return complete


@query(sql(f"""SELECT model, count(*) AS n_paid, sum(tin)::BIGINT AS input_tokens, sum(tout)::BIGINT AS output_tokens,
 {r('sum(((tin / 1000.0::DOUBLE) * CASE WHEN contains(model, $$gpt-4$$) THEN 0.01::DOUBLE ELSE 0.0015::DOUBLE END + (tout / 1000.0::DOUBLE) * CASE WHEN contains(model, $$gpt-4$$) THEN 0.03::DOUBLE ELSE 0.002::DOUBLE END)::DECIMAL(30, 8))::DOUBLE')} AS cost
FROM (SELECT DISTINCT model, max_tokens, prompt, length(prompt) // 4 AS tin, length('echo ' || task) // 4 AS tout FROM q_prompts) GROUP BY model""",
           "q_prompts"))
def resumed_model_calls(t):
    """What two runs have paid: the first asks for one model's prompts, the second for all."""
    prompts = written(N.render_prompts(t.turns, _plan(t)), "prompts")
    answers = StoredTable(t.spark, new_path(t.spark, "answers"), N.ANSWER)
    N.resume_model(prompts.filter(F.col("model") == K.CHEAP_MODEL), _echo(), answers, 2)
    N.resume_model(prompts, _echo(), answers, 2)
    return answers.read().groupBy("model").agg(
        F.count(F.lit(1)).alias("n_paid"), F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"), C.exact_sum("cost").alias("cost"))


@query(sql(f"""SELECT call_id, 0::BIGINT AS part, task, model, tin AS input_tokens, tout AS output_tokens, {r('cost * 1000000')} AS cost_micro_usd
FROM q_ledger""", "q_ledger"))
def cost_ledger(t):
    return N.cost_ledger(_outputs(t)).withColumn("cost", F.col("cost") * 1000000) \
        .withColumnRenamed("cost", "cost_micro_usd")


@query(sql(f"""SELECT model, n_calls, tokens, {r('cost')} AS cost, {r('sum(cost) OVER ()')} AS total_cost FROM (
 SELECT model, count(*) AS n_calls, sum(tin + tout)::BIGINT AS tokens, sum(cost::DECIMAL(30, 12))::DOUBLE AS cost FROM (
  SELECT model, tin, tout, cost FROM q_ledger UNION ALL SELECT 'embedding_sentence-transformers', count(*) * 100, 0,
   count(*) * 100 / 1000.0::DOUBLE * 0.00002::DOUBLE FROM seg) GROUP BY model)""", "q_ledger", "seg"))
def cost_ledger_summary(t):
    from parley.operators.search import embedding_cost
    model_calls = N.cost_ledger(_outputs(t)).select("model", "input_tokens", "output_tokens", "cost")
    indexing = embedding_cost(t.segments).select(
        "model", F.col("total_tokens").alias("input_tokens"),
        F.lit(0).cast("bigint").alias("output_tokens"), F.col("cost_usd").alias("cost"))
    return N.cost_ledger_summary(model_calls.unionByName(indexing))


_ENR_COLS = f"""enrichment_id, call_id, summary, to_json(key_issues)::VARCHAR AS key_issues,
 to_json([x FOR x, i IN actions IF list_position(actions, x) = i])::VARCHAR AS action_items,
 to_json([x FOR x, i IN tags IF list_position(tags, x) = i])::VARCHAR AS semantic_tags, model_used, tokens_used,
 {r('cost_usd')} AS cost_usd, {r('confidence_score')} AS confidence_score"""


@query(sql(f"SELECT {_ENR_COLS} FROM enr", "enr"))
def assemble_enrichment(t):
    return t.enrichments


@query(sql("""SELECT concat(call_id, '_ENRICH') AS enrichment_id, call_id, 'General inquiry call. No critical issues.' AS summary,
 '[]' AS key_issues, '[]' AS action_items, '["general","routine"]' AS semantic_tags, 'none' AS model_used,
 0::BIGINT AS tokens_used, 0::DOUBLE AS cost_usd, 0.5::DOUBLE AS confidence_score FROM pc WHERE NOT requires_enrichment""",
           "pc"))
def minimal_enrichment(t):
    return N.minimal_enrichment(t.pc)


@query(sql("SELECT call_id, to_json(issues)::VARCHAR AS issues, to_json(products)::VARCHAR AS products FROM tags", "tags"))
def keyword_tags(t):
    return N.keyword_tags(t.segments)


@query(sql("""SELECT count(*) AS flagged, count(*) FILTER (WHERE call_id IN (SELECT call_id FROM enriched)) AS enriched,
 count(*) FILTER (WHERE call_id NOT IN (SELECT call_id FROM enriched)) AS pending FROM pc WHERE requires_enrichment""",
           "pc", "enriched"))
def enrichment_backlog(t):
    return N.enrichment_backlog(t.pc, t.enriched)


_ALL = """SELECT model_used, tokens_used, cost_usd FROM enr
 UNION ALL SELECT 'none', 0, 0::DOUBLE FROM pc WHERE NOT requires_enrichment"""


def _all_enrichments(t):
    return t.enrichments.unionByName(N.minimal_enrichment(t.pc))


@query(sql(f"""SELECT model_used, count(*) AS num_calls, sum(tokens_used)::BIGINT AS total_tokens,
 {r('sum(cost_usd::DECIMAL(30, 8))::DOUBLE')} AS total_cost FROM ({_ALL}) GROUP BY 1""", "enr", "pc"))
def cost_by_model(t):
    return C.cost_by_model(_all_enrichments(t))


@query(sql(f"""SELECT model_used, num_calls, {r('total_cost')} AS total_cost, (sum(num_calls) OVER ())::BIGINT AS total_enrichments,
 {r('sum(total_cost) OVER ()')} AS total_cost_usd, {r('sum(total_cost) OVER () / sum(num_calls) OVER ()')} AS avg_cost_per_call
FROM (SELECT model_used, count(*) AS num_calls, sum(cost_usd::DECIMAL(30, 8))::DOUBLE AS total_cost FROM ({_ALL}) GROUP BY 1)""",
           "enr", "pc"))
def enrichment_statistics(t):
    return C.enrichment_statistics(_all_enrichments(t))


@query(sql(f"""SELECT total_calls, processed, preprocessed, enriched, {r('total_cost')} AS total_cost,
 {r('coalesce(total_cost / nullif(enriched, 0), 0)')} AS avg_cost FROM (SELECT count(*) AS total_calls,
 count(*) FILTER (WHERE call_id IN (SELECT call_id FROM pc)) AS processed,
 count(*) FILTER (WHERE call_id IN (SELECT call_id FROM pc)) AS preprocessed,
 count(*) FILTER (WHERE call_id IN (SELECT call_id FROM enriched)) AS enriched,
 (SELECT coalesce(sum(cost_usd::DECIMAL(30, 8))::DOUBLE, 0) FROM enr) AS total_cost FROM calls)""",
           "calls", "pc", "enriched", "enr"))
def system_statistics(t):
    return C.system_statistics(t.flagged_calls, t.enrichments)


@query(sql(f"""SELECT n_calls, n_enriched, {r('total_cost')} AS total_cost, {r('a')} AS avg_cost, {r('a * 1000000')} AS cost_per_million,
 {r('a * n_calls')} AS cost_all_calls, {r('a * n_calls - total_cost')} AS savings,
 {r('(a * n_calls - total_cost) * 100 / nullif(a * n_calls, 0)')} AS savings_pct FROM (SELECT *, total_cost / nullif(n_enriched, 0) AS a
 FROM (SELECT count(*) AS n_enriched, sum(cost_usd::DECIMAL(30, 8))::DOUBLE AS total_cost, (SELECT count(*) FROM calls) AS n_calls FROM enr))""",
           "calls", "enr"))
def cost_projection(t):
    return C.cost_projection(t.calls, t.enrichments)


view("search_docs", """SELECT s.segment_id, s.call_id, s.speaker, s.text, s.intent, s.sentiment, s.importance_score,
 c.product, c.client_segment, c.call_timestamp, concat_ws(' | ', s.text, 'Summary: ' || e.summary,
 'Tags: ' || array_to_string([x FOR x, i IN e.tags IF list_position(e.tags, x) = i], ', ')) AS document
FROM seg s LEFT JOIN enr e USING (call_id) JOIN calls c USING (call_id)""", "seg", "enr", "calls")


@query(sql(f"""SELECT * REPLACE ({r('importance_score')} AS importance_score) FROM search_docs""", "search_docs"))
def build_search_documents(t):
    return build(t.segments, t.enrichments, t.calls)


@query(sql(f"""SELECT segment_id, s.call_id, s.speaker, s.text, s.intent, s.sentiment, {r('s.importance_score')} AS importance_score,
 e.summary, to_json(e.key_issues)::VARCHAR AS key_issues, to_json([x FOR x, i IN e.tags IF list_position(e.tags, x) = i])::VARCHAR
 AS semantic_tags, c.product, c.client_segment, c.call_timestamp
FROM seg s LEFT JOIN enr e USING (call_id) JOIN calls c USING (call_id)""", "seg", "enr", "calls"))
def search_documents(t):
    return C.search_documents_base(t.segments, t.enrichments, t.calls)

