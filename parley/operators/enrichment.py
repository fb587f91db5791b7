"""Selective enrichment: queue, prompts, pluggable model, results, costs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from parley import constants as K
from parley.functions import text as X
from parley.functions import triage as T
from parley.operators.calls import analyze_segments, enrichment_queue
from parley.operators.summaries import extractive_summary
from parley.plans.ordered import part_of
from parley.sources.stored import StoredTable
from parley.sources.transcripts import assemble_transcript
from parley.plans.workspace import spread, written

# The four tasks, their instructions and output limits.
TASKS = {
    "summary": ("Summarize this customer support call in 2-3 sentences.\n"
                "Focus on the main issue and resolution.",
                "Provide a concise summary:", 150),
    "key_issues": ("Extract the key issues from this call.\nReturn as a JSON array of strings.",
                   "Key issues (JSON array):", 100),
    "action_items": ("Extract action items from this call.\n"
                     "Return as a JSON array of strings.",
                     "Action items (JSON array):", 100),
    "semantic_tags": ("Generate 3-5 semantic tags for this call for search and "
                      "categorization.\nReturn as a JSON array of lowercase strings.",
                      "Semantic tags (JSON array):", 50),
}
MINIMAL_SUMMARY = "General inquiry call. No critical issues."
MINIMAL_TAGS = ("general", "routine")
CONFIDENCE = {K.EXPENSIVE_MODEL: 0.85, K.CHEAP_MODEL: 0.75}
MINIMAL_CONFIDENCE = 0.5
NO_OUTPUT = "no text came back"
# Bytes of prompts that a task has as Python objects at once.
PROMPT_BYTES = 4 << 20


def plan_enrichment(pc: DataFrame, enriched: DataFrame, force: bool = False) -> DataFrame:
    """Flagged calls without a result, each with its model."""
    return enrichment_queue(pc, enriched).select(
        "call_id", "overall_importance",
        T.select_model(F.col("overall_importance"), force).alias("model"))


def render_prompts(turns: DataFrame, plan: DataFrame, part_turns: int | None = None) -> DataFrame:
    """Four prompts per planned call; with `part_turns`, per part of so many turns."""
    text = assemble_transcript(turns.join(spread(plan.select("call_id")), "call_id", "left_semi"),
                               part_turns)
    prompts = F.array(*[F.struct(
        F.lit(task).alias("task"),
        F.concat(F.lit(head + "\n\nCall transcript:\n"), F.col("transcript_text"),
                 F.lit("\n\n" + tail)).alias("prompt"),
        F.lit(limit).alias("max_tokens")) for task, (head, tail, limit) in TASKS.items()])
    return (text.join(spread(plan.select("call_id", "model")), "call_id")
            .select("call_id", "part", "model", F.explode(prompts).alias("p"))
            .select("call_id", "part", "model", "p.*"))


def keyword_tags(segments: DataFrame) -> DataFrame:
    """Issues and products mentioned anywhere in the call, sorted."""
    item = F.array_union(
        F.transform("issues_mentioned", lambda i: F.struct(F.lit("issue").alias("kind"),
                                                           i.alias("name"))),
        F.transform("products_mentioned", lambda p: F.struct(F.lit("product").alias("kind"),
                                                             p.alias("name"))))
    found = segments.select("call_id", F.explode(item).alias("m")).groupBy("call_id").agg(
        F.collect_set("m").alias("m"))      # both vocabularies are constants
    names = lambda kind: F.array_sort(F.transform(
        F.filter("m", lambda x: x["kind"] == kind), lambda x: x["name"]))
    return found.select("call_id", names("issue").alias("issues"),
                        names("product").alias("products"))


def action_turns(turns: DataFrame, part_turns: int | None = None) -> DataFrame:
    """Turns with resolution language, in order, per call; `part` as in the prompts."""
    hits = turns.filter(X.is_resolution(F.col("text")))
    packed = hits.groupBy("call_id", part_of("turn_index", part_turns).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("turn_index", "text"))).alias("l"))
    return packed.select("call_id", "part",
                         F.transform("l", lambda x: x["text"]).alias("actions"))


def rule_outputs(prompts: DataFrame, turns: DataFrame, segments: DataFrame,
                 quality: str = "fast") -> DataFrame:
    """Outputs of the rule backend for every prompt, from joins only."""
    tags = keyword_tags(segments)
    empty = F.array().cast("array<string>")
    base = (prompts.join(spread(extractive_summary(turns, quality)), ["call_id", "part"], "left")
            .join(spread(tags), "call_id", "left").join(spread(action_turns(turns)), ["call_id", "part"], "left"))
    issues, products = F.coalesce("issues", empty), F.coalesce("products", empty)
    output = (F.when(F.col("task") == "summary", F.coalesce("summary", F.lit(K.NO_CONTENT)))
              .when(F.col("task") == "key_issues", X.encode_list(issues))
              .when(F.col("task") == "action_items",
                    X.encode_list(F.coalesce("actions", empty)))
              .otherwise(X.encode_list(F.concat(issues, products))))
    return with_usage(base.select("call_id", "part", "model", "task", "prompt", "max_tokens",
                                  output.alias("output")))


def apply_model(prompts: DataFrame, complete) -> DataFrame:
    """Send prompts to a model.

    `complete(list of prompts, list of models, list of limits) -> list of texts`
    is called on the executors, for up to PROMPT_BYTES of prompts (or one longer one) of an
    Arrow batch at a time.  Prompts of a failing call are sent again one by one; those that fail
    again, or whose output is not a text, keep their error and cost nothing.
    """
    schema = T_.StructType([*prompts.schema.fields, T_.StructField("output", T_.StringType()),
                            T_.StructField("error", T_.StringType())])

    def run(batches):
        import pyarrow as pa
        for batch in (piece for whole in batches for piece in in_pieces(whole, "prompt", PROMPT_BYTES)):
            asked = list(zip(*[batch.column(c).to_pylist() for c in ("prompt", "model", "max_tokens")]))
            outputs, problem = attempt(asked)
            if problem is None:
                done = [(x, None if isinstance(x, str) else NO_OUTPUT) for x in outputs]
            else:
                alone = [attempt([one]) for one in asked]
                done = [(None, bad) if bad else (x[0], None if isinstance(x[0], str) else NO_OUTPUT)
                        for x, bad in alone]
            # the prompts go back as they came, without becoming Python objects again
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(list(c), pa.string()) for c in zip(*done)]], names=schema.names)

    def attempt(asked):
        try:
            outputs = list(complete(*map(list, zip(*asked)))) if asked else []
            if len(outputs) != len(asked):
                raise ValueError(f"{len(outputs)} outputs for {len(asked)} prompts")
            return outputs, None
        except Exception as problem:                  # noqa: BLE001 - reported per row
            return None, str(problem) or type(problem).__name__

    return with_usage(prompts.mapInArrow(run, schema))


def in_pieces(batch, column: str, size: int):
    """Slices of an Arrow batch with up to `size` bytes of a text column, or one row beyond."""
    import pyarrow.compute as pc
    start = held = 0
    for at, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if at > start and held + (n or 0) > size:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


#: What is kept of an answered prompt.
ANSWER = "key string, model string, output string, input_tokens long, output_tokens long, cost double"


def prompt_key() -> Column:
    """Prompts with the same text, model and limit are one."""
    return F.sha2(F.concat_ws("\x1f", F.col("model"), F.col("max_tokens").cast("string"), F.col("prompt")), 256)


def resume_model(prompts: DataFrame, complete, answers: StoredTable, steps: int = 8) -> DataFrame:
    """`apply_model` that asks only what has no stored answer yet, and stores what it gets.

    Equal prompts are asked once.  They go in `steps` lots, each committed when its answers are
    there, so a run that dies loses one lot at most and the next run goes on behind it; within a lot a
    retried task asks its own prompts again.  Failed prompts aren't stored and will be asked by
    the next run.  The result has every prompt, with a null output where it failed.  `answers`
    (of `ANSWER`) is the ledger: one row per prompt paid for.
    """
    keyed = written(prompts.withColumn("key", prompt_key()), "prompts")
    todo = keyed.dropDuplicates(["key"]).join(spread(answers.read().select("key")), "key", "left_anti")
    todo, run = written(todo, "unanswered"), uuid.uuid4().hex
    if not todo.isEmpty():
        for k in range(steps):
            lot = apply_model(todo.filter(F.pmod(F.xxhash64("key"), F.lit(steps)) == k), complete)
            answers.append(lot.filter("error IS NULL").withColumn("cost", F.col("cost").cast("double")), f"{run}-{k}")
    known = answers.read().drop("model")
    return keyed.join(spread(known), "key", "left").drop("key")


def with_usage(outputs: DataFrame) -> DataFrame:
    """Token counts and price of each model call."""
    used = (outputs.withColumn("input_tokens", X.approx_tokens(F.col("prompt")))
            .withColumn("output_tokens",
                        F.coalesce(X.approx_tokens(F.col("output")), F.lit(0).cast("bigint"))))
    cost = T.model_cost(F.col("input_tokens"), F.col("output_tokens"), F.col("model"))
    failed = F.col("error").isNotNull() if "error" in outputs.columns else F.lit(False)
    return used.withColumn("cost", F.when(failed, F.lit(0.0)).otherwise(cost))


def failed_outputs(outputs: DataFrame) -> DataFrame:
    """The prompts without an output, with their errors, for counting and retries."""
    return outputs.filter("error IS NOT NULL").select("call_id", "part", "task", "model", "error")


def cost_ledger(outputs: DataFrame) -> DataFrame:
    """One row per model call."""
    return outputs.select("call_id", "part", "task", "model", "input_tokens", "output_tokens",
                          "cost")


def cost_ledger_summary(ledger: DataFrame) -> DataFrame:
    """Calls, tokens and cost per model, next to the total."""
    from pyspark.sql import Window

    from parley.operators.calls import exact_sum
    by_model = ledger.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("tokens"),
        exact_sum("cost", 12).alias("cost"))
    return by_model.withColumn("total_cost", F.sum("cost").over(Window.partitionBy()))


def assemble_enrichment(outputs: DataFrame) -> DataFrame:
    """The four outputs of each call as one `enrichments` row.

    A call with a failed prompt gets no row and so stays pending.
    Money is summed and rounded in decimals, so ties round the same everywhere.
    """
    if "error" in outputs.columns:
        failed = failed_outputs(outputs).select("call_id").distinct()
        outputs = outputs.join(spread(failed), "call_id", "left_anti")
    task = lambda name: F.when(F.col("task") == name, F.col("output"))
    money = "decimal(30,12)"
    parts = outputs.groupBy("call_id", "part").agg(
        F.max("model").alias("model"), *[F.max(task(t)).alias(t) for t in TASKS],
        F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("tokens"),
        F.sum(F.col("cost").cast(money)).alias("cost"))
    lists = {t: X.decode_list(F.col(t)) for t in list(TASKS)[1:]}
    # one part unless the prompts were cut; outputs are bounded by max_tokens
    calls = parts.groupBy("call_id").agg(
        F.max("model").alias("model_used"),
        F.array_sort(F.collect_list(F.struct("part", F.col("summary").alias("t"))))
        .alias("summaries"),
        *[F.array_sort(F.collect_list(F.struct("part", v.alias("t")))).alias(t)
          for t, v in lists.items()],
        F.sum("tokens").alias("tokens_used"), F.sum("cost").alias("cost_usd"))
    joined = lambda t: F.array_distinct(F.flatten(F.transform(t, lambda x: x["t"])))
    return calls.select(
        F.concat(F.col("call_id"), F.lit("_ENRICH")).alias("enrichment_id"), "call_id",
        F.array_join(F.transform("summaries", lambda x: x["t"]), " ").alias("summary"),
        *[joined(t).alias(t) for t in lists], "model_used", "tokens_used",
        F.round("cost_usd", 4).cast("double").alias("cost_usd"),
        T.lookup(F.col("model_used"), CONFIDENCE, CONFIDENCE[K.CHEAP_MODEL])
        .alias("confidence_score"))


def minimal_enrichment(pc: DataFrame) -> DataFrame:
    """The constant result of calls that were not flagged."""
    empty = F.array().cast("array<string>")
    return pc.filter(~F.col("requires_enrichment")).select(
        F.concat(F.col("call_id"), F.lit("_ENRICH")).alias("enrichment_id"), "call_id",
        F.lit(MINIMAL_SUMMARY).alias("summary"), empty.alias("key_issues"),
        empty.alias("action_items"), F.array(*[F.lit(t) for t in MINIMAL_TAGS])
        .alias("semantic_tags"), F.lit("none").alias("model_used"),
        F.lit(0).cast("bigint").alias("tokens_used"), F.lit(0.0).alias("cost_usd"),
        F.lit(MINIMAL_CONFIDENCE).alias("confidence_score"))


def model_outputs(turns: DataFrame, plan: DataFrame, complete=None) -> DataFrame:
    """Plan to model outputs, with a model hook or the rule backend.

    Only the turns of planned calls are read further; they and the plan are
    written once, because prompts, summaries and tags each need them.
    """
    plan = written(plan.select("call_id", "model"), "plan")
    turns = written(turns.join(spread(plan.select("call_id")), "call_id", "left_semi"), "planned-turns")
    prompts = render_prompts(turns, plan)
    if complete:
        return apply_model(prompts, complete)
    return rule_outputs(prompts, turns, analyze_segments(turns))


def enrich(turns: DataFrame, plan: DataFrame, complete=None) -> DataFrame:
    """Plan to `enrichments` rows."""
    return assemble_enrichment(model_outputs(turns, plan, complete))


def enrichment_backlog(pc: DataFrame, enriched: DataFrame) -> DataFrame:
    done = enriched.select("call_id", F.lit(True).alias("done")).distinct()
    flagged = pc.filter("requires_enrichment").join(done, "call_id", "left")
    return flagged.agg(F.count(F.lit(1)).alias("flagged"),
                       F.count_if(F.col("done").isNotNull()).alias("enriched"),
                       F.count_if(F.col("done").isNull()).alias("pending"))
