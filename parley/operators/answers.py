"""Batch retrieval-augmented answers for a table of questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley import constants as K
from parley.functions import text as X
from parley.operators.calls import metadata_filter
from parley.operators.search import embed_texts, hybrid_text_search, vector_search
from parley.operators.turns import context_budget
from parley.plans.workspace import written

# Fixed value: the prompt around the retrieved context.
PROMPT_HEAD = "You are an AI assistant analyzing customer support call transcripts."
PROMPT_TAIL = """Instructions:
1. Answer the user's question based ONLY on the provided transcripts
2. Be specific and cite evidence from the transcripts
3. If the transcripts don't contain enough information, say so
4. Organize your answer clearly
5. Highlight key insights and patterns

Answer:"""


def retrieve(questions: DataFrame, documents: DataFrame, k: int = K.TOP_K,
             filters: dict | None = None, hybrid: bool = True) -> DataFrame:
    """Top-k documents of every question, with the documents' columns.

    `questions` has (query_id, query_text); filters apply before the search, so
    k results come back whenever k documents match.
    """
    docs = metadata_filter(documents, filters or {})
    asked = embed_texts(questions, "query_text", "query_vec")
    if hybrid:
        # a segment comes once per call that its id stands for, with the same document
        hits = hybrid_text_search(asked, "query_id", "query_text", "query_vec", docs, "segment_id",
                                  "document", embed_texts, k)
    else:
        hits = vector_search(asked, "query_id", "query_vec", embed_texts(docs, "document"),
                             "segment_id", "embedding", k)
    return written(hits, "ranked").join(documents, "segment_id")


def rerank(results: DataFrame, k: int = K.RERANK_K) -> DataFrame:
    return results.filter(F.col("rank") <= k)


def _in_rank_order(column, separator):
    return F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("rank", column.alias("t")))), lambda x: x["t"]), separator)


def build_context(results: DataFrame, budget: int = K.CONTEXT_TOKENS) -> DataFrame:
    """One context text per question: formatted results up to the token budget."""
    missing = lambda c: F.coalesce(F.col(c), F.lit("N/A"))
    block = F.concat(
        F.lit("\n[Call "), F.col("rank").cast("string"), F.lit("]\nProduct: "),
        missing("product"), F.lit("\nIntent: "), missing("intent"), F.lit("\nSentiment: "),
        missing("sentiment"), F.lit("\nRelevance: "), X.two_decimals(F.col("score")),
        F.lit("\n\nTranscript:\n"), F.col("text"), F.lit("\n---\n"))
    blocks = results.withColumn("block", block)
    kept = context_budget(blocks, ["query_id"], "rank", X.approx_tokens(F.col("block")), budget)
    return kept.groupBy("query_id").agg(_in_rank_order(F.col("block"), "\n").alias("context"),
                                        F.count(F.lit(1)).alias("n_blocks"))


def citations(results: DataFrame) -> DataFrame:
    """`[i] Call id - product - Score: x.xx`, one line per source."""
    line = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] Call "), F.col("call_id"),
                    F.lit(" - "), F.coalesce("product", F.lit("N/A")), F.lit(" - Score: "),
                    X.two_decimals(F.col("score")))
    return results.groupBy("query_id").agg(_in_rank_order(line, "\n").alias("citations"))


def answer_confidence(questions: DataFrame, results: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    score = F.least(F.lit(1.0), F.sum("score") / n * F.lit(0.7)
                    + F.least(n / F.lit(5.0), F.lit(1.0)) * F.lit(0.3))
    found = results.groupBy("query_id").agg(n.alias("n_sources"), score.alias("confidence"))
    return questions.select("query_id").join(found, "query_id", "left").select(
        "query_id", F.coalesce("n_sources", F.lit(0)).alias("n_sources"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def answer_table(questions: DataFrame, results: DataFrame, complete=None) -> DataFrame:
    """Question to answer text, citations, confidence, model and cost.

    `questions` has (query_id, query_text, mode).  Without a model hook the
    answer quotes the best sources; a question without results gets the fixed
    message, confidence 0 and no model.
    """
    from parley.operators.enrichment import apply_model, with_usage

    top = rerank(results)
    quotes = top.groupBy("query_id").agg(_in_rank_order(F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.col("text")), "\n")
        .alias("quotes"))
    base = (questions.join(build_context(top), "query_id").join(citations(top), "query_id")
            .join(quotes, "query_id"))
    model = F.when(F.col("mode") == "deep", K.EXPENSIVE_MODEL).otherwise(K.CHEAP_MODEL)
    prompt = F.concat(F.lit(PROMPT_HEAD + "\n\nUser Question:\n"), F.col("query_text"),
                      F.lit("\n\nRelevant Call Transcripts:\n"), F.col("context"),
                      F.lit("\n\n" + PROMPT_TAIL))
    asked = base.select("query_id", "citations", "quotes", model.alias("model"),
                        prompt.alias("prompt"), F.lit(500).alias("max_tokens"))
    if complete:
        done = apply_model(asked, complete)
    else:
        done = with_usage(asked.withColumn("output", F.col("quotes")))
    done = done.select("query_id", "citations", "output", "model", "cost",
                       (F.col("input_tokens") + F.col("output_tokens")).alias("tokens"))
    sure = answer_confidence(questions, top)
    return (questions.join(done, "query_id", "left").join(sure, "query_id").select(
        "query_id", "query_text", "mode", F.coalesce("output", F.lit(K.ANSWER_NONE))
        .alias("answer"), "confidence", "n_sources",
        F.coalesce("citations", F.lit("")).alias("citations"),
        F.coalesce("model", F.lit("none")).alias("model_used"),
        F.coalesce("tokens", F.lit(0)).alias("tokens_used"),
        F.coalesce("cost", F.lit(0.0)).alias("cost_usd")))


def search_answer(questions: DataFrame, results: DataFrame) -> DataFrame:
    """"Found n …" with five previews; confidence 0.7, or 0 when nothing matched."""
    line = F.concat(F.col("rank").cast("string"), F.lit(". "), X.preview(F.col("text"), 150),
                    F.lit("\n   (Relevance: "), X.two_decimals(F.col("score")), F.lit(")\n\n"))
    found = results.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("rank") <= 5, F.struct("rank", line.alias("t"))))),
            lambda x: x["t"]), "").alias("lines"))
    return questions.join(found, "query_id", "left").select(
        "query_id", "query_text",
        F.when(F.col("n").isNull(), K.SEARCH_NONE).otherwise(F.concat(
            F.lit("Found "), F.col("n").cast("string"), F.lit(" relevant call segments:\n\n"),
            F.col("lines"))).alias("answer"),
        F.when(F.col("n").isNull(), F.lit(0.0)).otherwise(F.lit(0.7)).alias("confidence"))


def answer_analytics(questions: DataFrame, results: DataFrame, pc: DataFrame) -> DataFrame:
    """Per question: distinct calls among the results and their sentiments."""
    hit_calls = results.select("query_id", "call_id").distinct()
    counts = hit_calls.join(pc.select("call_id", "overall_sentiment"), "call_id").groupBy(
        "query_id").agg(F.count(F.lit(1)).alias("total_matching_calls"), *[
            F.count_if(F.col("overall_sentiment") == s).alias(s) for s in K.SENTIMENTS])
    out = questions.select("query_id").join(counts, "query_id", "left")
    return out.select("query_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in
                                    ("total_matching_calls", *K.SENTIMENTS)])


def question_table(log: DataFrame) -> DataFrame:
    """Distinct questions of a log, with the deepest mode asked for.

    The id is the question's own hash, so it is the same on every run.
    """
    return log.groupBy("query_text").agg(
        F.max(F.when(F.col("mode") == "deep", 2).when(F.col("mode") == "balanced", 1)
              .otherwise(0)).alias("m")).select(
        F.md5("query_text").alias("query_id"), "query_text",
        F.when(F.col("m") == 2, "deep").when(F.col("m") == 1, "balanced").otherwise("cheap")
        .alias("mode"))
