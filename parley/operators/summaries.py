"""Summarisation of long conversations: noise removal, salience, extraction, quality.

Stages whose rows are read several times afterwards (filtered turns, scored
turns, chunks) are written once to the shared folder: it keeps plans small,
avoids repeating the fold over each call, and survives lost executors.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley import constants as K
from parley.functions import text as X
from parley.functions import triage as T
from parley.functions import vectors as V
from parley.operators import turns as O
from parley.operators.search import exploded_counts, keyword_scores
from parley.plans.ordered import TURN_BLOCK, dense_position, part_of
from parley.plans.workspace import spread, written


# --- noise ------------------------------------------------------------------
def noise_filter(turns: DataFrame, aggressive: bool = False) -> DataFrame:
    """Trim greetings, drop procedural turns, clean fillers, drop repetitions and
    very short turns, in that order."""
    out = O.filter_procedural(O.trim_opening_closing(turns), aggressive)
    out = out.withColumn("text", X.clean_fillers(F.col("text")))
    return O.drop_short_turns(O.remove_repetitions(out, bound=turns))


def noise_filter_full(turns: DataFrame, aggressive: bool = False) -> DataFrame:
    """The longer documented variant with hold notices and look-back repetitions."""
    out = O.filter_procedural(O.trim_opening_closing_prefix(turns), aggressive,
                              K.PROCEDURAL_FULL_RX)
    out = O.drop_hold_turns(out.withColumn("text", X.clean_fillers_full(F.col("text"))))
    out = O.remove_repetitions_lag(O.renumber(out, bound=turns), position="pos").drop("pos")
    return O.drop_short_turns(out)


def turn_and_word_counts(turns: DataFrame, prefix: str, keys=("call_id",)) -> DataFrame:
    return turns.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"{prefix}_turns"),
        F.sum(X.word_count(F.col("text"))).alias(f"{prefix}_tokens"))


def noise_reduction_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Turns and words before and after, per call, with the share removed."""
    out = turn_and_word_counts(before, "original").join(
        turn_and_word_counts(after, "filtered"), "call_id", "left")
    for c in ("filtered_turns", "filtered_tokens"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    kept = F.try_divide("filtered_tokens", "original_tokens")
    kept_turns = F.try_divide("filtered_turns", "original_turns")
    return (out.withColumn("noise_removed_pct", (F.lit(1.0) - kept) * F.lit(100.0))
            .withColumn("turn_reduction_pct", (F.lit(1.0) - kept_turns) * F.lit(100.0)))


# --- salience ---------------------------------------------------------------
def turn_tfidf_score(turns: DataFrame, max_features: int = 100, keys=("call_id",),
                     index: str = "turn_index", min_max: bool = False) -> DataFrame:
    """`tfidf_score` of each turn within its group, scaled to 0..1.

    A turn's value is the sum of its unit-length TF-IDF vector over the group's
    `max_features` most frequent terms; 0.5 where the group has no terms at all.
    Everything is keyed by (group, term) or (group, turn), so a long call spreads.
    """
    keys = list(keys)
    # read three times
    tf = written(exploded_counts(turns, "text", False, *keys, index), "turn-terms")
    w = Window.partitionBy(*keys).orderBy(F.desc("total"), "term")
    frequent = (tf.groupBy(*keys, "term").agg(F.sum("tf").alias("total"),
                                              F.count(F.lit(1)).alias("df"))
                .withColumn("r", F.row_number().over(w)).filter(F.col("r") <= max_features))
    n = turns.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    vocab = frequent.join(spread(n), keys).select(
        *keys, "term", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1.0).alias("idf"))
    weight = F.col("tf") * F.col("idf")
    sums = tf.join(spread(vocab), [*keys, "term"]).groupBy(*keys, index).agg(
        # rounded, so that equal turns stay equal when min and max are subtracted
        F.round(F.sum(weight) / F.sqrt(F.sum(weight * weight)), 12).alias("row_sum"))
    bounds = sums.groupBy(*keys).agg(
        F.max("row_sum").alias("hi"), F.min("row_sum").alias("lo"),
        F.count(F.lit(1)).alias("n_with_terms"))
    if min_max:
        bounds = bounds.join(spread(n), keys).withColumn(
            "lo", F.when(F.col("n_with_terms") < F.col("n"), F.lit(0.0)).otherwise(F.col("lo")))
    else:
        bounds = bounds.withColumn("lo", F.lit(0.0))
    value = F.coalesce(F.col("row_sum"), F.lit(0.0))
    scaled = (value - F.col("lo")) / (F.col("hi") - F.col("lo") + F.lit(1e-10))
    return (turns.join(spread(sums), [*keys, index], "left")
            .join(spread(bounds.select(*keys, "hi", "lo")), keys, "left")
            .withColumn("tfidf_score", F.round(F.coalesce(scaled, F.lit(0.5)), 9))
            .drop("row_sum", "hi", "lo"))


def _bonus(condition: Column, value: float) -> Column:
    return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))


def turn_salience(turns: DataFrame, max_features: int = 100, keys=("call_id",),
                  index: str = "turn_index") -> DataFrame:
    """TF-IDF, customer speech and negative words as one `score`."""
    scored = turn_tfidf_score(turns, max_features, keys, index)
    return scored.withColumn("score", F.round(
        F.col("tfidf_score") * F.lit(0.5) + _bonus(T.is_customer(F.col("speaker")), 0.3)
        + _bonus(X.has_negative_words(F.col("text")), 0.2), 6))


def turn_salience_multi(turns: DataFrame, keys=("call_id",), index: str = "turn_index",
                        position: str = "turn_index") -> DataFrame:
    """Six-signal variant; `position` counts 0, 1, … within the group."""
    keys = list(keys)
    scored = turn_tfidf_score(turns, 1000, keys, index, min_max=True)
    n = turns.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_turns"))
    text = F.col("text")
    score = (F.col("tfidf_score") * F.lit(0.3)
             + X.position_score(F.col(position), F.col("n_turns")) * F.lit(0.15)
             + _bonus(T.is_customer(F.col("speaker")), 0.2)
             + _bonus(X.word_count(text).between(5, 40), 0.1)
             + X.keyword_importance(text) * F.lit(0.15)
             + _bonus(X.has_negative_words(text, K.NEGATIVE_WORDS_MULTI), 0.1))
    return scored.join(spread(n), keys).withColumn("score", F.round(score, 6)).drop("n_turns")


def importance_chunk(turns: DataFrame, max_tokens: int = 2000) -> DataFrame:
    """The most important turns (by the triage score) that fit the budget."""
    score = T.text_importance(F.col("text"), F.col("speaker"))
    return O.extractive_select(turns.withColumn("score", F.round(score, 6)), max_tokens)


# --- summaries --------------------------------------------------------------
def extractive_turns(filtered: DataFrame, quality: str = "balanced",
                     target: int | None = None) -> DataFrame:
    """The selected turns; 500 words in fast mode, 2000 otherwise."""
    target = target or (500 if quality == "fast" else 2000)
    # what the selection reads several times is written with the scores
    scored = written(O.sized_turns(turn_salience(written(filtered, "filtered-turns"))), "scored-turns")
    return O.extractive_select(scored, target)


def extractive_summary(turns: DataFrame, quality: str = "balanced",
                       target: int | None = None) -> DataFrame:
    """One text per call; `part` is always 0."""
    chosen = extractive_turns(noise_filter(turns), quality, target)
    chosen = written(chosen, "summary-turns")
    calls = turns.select("call_id").distinct()
    return calls.join(spread(O.run_summary(chosen)), "call_id", "left").select(
        "call_id", F.lit(0).cast("bigint").alias("part"), F.coalesce("summary_text", F.lit(K.NO_CONTENT)).alias("summary"))


def summary_metrics(turns: DataFrame, quality: str = "balanced",
                    target: int | None = None) -> DataFrame:
    """Words at each stage, compression and share of noise, per call."""
    filtered = written(noise_filter(turns), "filtered-turns")
    chosen = written(extractive_turns(filtered, quality, target), "summary-turns")
    extracted = chosen.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("final_turns"),
        F.sum(X.word_count(F.col("text"))).alias("extracted_tokens"))
    final = (extractive_final_words(chosen))
    out = (noise_reduction_stats(turns, filtered).drop("turn_reduction_pct")
           .join(extracted, "call_id", "left").join(final, "call_id", "left"))
    for c in ("final_turns", "extracted_tokens"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    n_empty = len(K.NO_CONTENT.split())
    out = out.withColumn("final_tokens", F.coalesce("final_tokens", F.lit(n_empty)))
    return out.withColumn("compression_ratio", F.try_divide("final_tokens", "original_tokens"))


def extractive_final_words(chosen: DataFrame) -> DataFrame:
    return O.run_summary(chosen).groupBy("call_id").agg(
        F.sum(X.word_count(F.col("summary_text"))).alias("final_tokens"))


def hierarchical_segments(turns: DataFrame, max_words: int = 1500) -> DataFrame:
    """Filtered turns with their merged topic chunk."""
    filtered = written(noise_filter_full(turns), "filtered-turns")
    filtered = written(dense_position(filtered, ["call_id"], "turn_index", "pos", bound=filtered), "positions")
    chunked = O.semantic_chunks(filtered, position="pos")
    scored = chunked.withColumn("turn_score", T.text_importance(
        F.col("text"), F.col("speaker")))
    scored = written(scored, "chunked-turns")
    merged = O.merge_small_segments(O.segment_table(scored, F.col("turn_score")), max_words)
    return scored.join(merged.select("call_id", "segment", "chunk"), ["call_id", "segment"])


def hierarchical_summary(turns: DataFrame, max_words: int = 1500, per_segment: int = 600,
                         keep: int = 3) -> DataFrame:
    """Summarise segments, then join the segment summaries per call.

    Map step: the best turns of each segment within `per_segment` words, of
    which the first `keep` are quoted.  Reduce step: the texts in order.
    """
    rows = written(hierarchical_segments(turns, max_words), "segment-turns")
    keys = ["call_id", "chunk"]
    ranked = dense_position(rows.drop("pos"), keys, "turn_index", "pos", bound=rows)
    scored = written(turn_salience_multi(written(ranked, "ranked-turns"), keys,
                                         position="pos"), "scored-turns")
    best = O.extractive_select(scored, per_segment, keys=keys)
    w = Window.partitionBy(*keys).orderBy("turn_index")
    quoted = best.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= keep)
    line = F.concat(F.lit("["), F.upper("speaker"), F.lit("]: "), F.col("text"))
    texts = quoted.groupBy(*keys).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("turn_index", line.alias("line")))),
        lambda x: x["line"]), "\n").alias("summary"))
    facts = rows.groupBy(*keys).agg(
        F.min("segment").alias("segment"), F.max("turn_score").alias("importance"),
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))
    topics = O.topic_label(rows.select("call_id", "segment", "turn_index", "text"))
    return (facts.join(texts, keys, "left").join(topics, ["call_id", "segment"], "left")
            .select("call_id", (F.col("chunk") + 1).alias("segment_number"),
                    F.coalesce("topic", F.lit("")).alias("topic"), "importance",
                    X.time_range_label(F.col("start_time"), F.col("end_time"))
                    .alias("time_range"), F.coalesce("summary", F.lit("")).alias("summary")))


def final_summary(segments: DataFrame, part_size: int | None = None) -> DataFrame:
    """Segment summaries in order, one row per call, or per part of `part_size` segments."""
    packed = segments.groupBy("call_id", part_of(F.col("segment_number") - 1, part_size).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("segment_number", "summary"))).alias("l"),
        F.count(F.lit(1)).alias("num_segments"))
    return packed.select("call_id", "part", "num_segments", F.array_join(
        F.transform("l", lambda x: x["summary"]), " ").alias("summary"))


PHASE_PARTS = {"issue": (("opening", "investigation"), 2), "resolution": (("resolution",), 2),
               "outcome": (("closing",), 1)}


def phase_summary(turns: DataFrame) -> DataFrame:
    """Issue, resolution and outcome: the most important turns of each phase."""
    text = F.col("text")
    part = F.lit(None)
    for name, (phases, _) in PHASE_PARTS.items():
        part = F.when(F.col("phase").isin(*phases), name).otherwise(part)
    limit = T.lookup(F.col("part"), {n: k for n, (_, k) in PHASE_PARTS.items()}, 0)
    score = F.round(T.text_importance(text, F.col("speaker")), 6)
    scored = O.call_phases(turns).select("call_id", "turn_index", "text", part.alias("part"),
                                         score.alias("score"))
    w = Window.partitionBy("call_id", "part").orderBy(F.desc("score"), "turn_index")
    best = (scored.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= 2)
            .filter(F.col("r") <= limit))
    joined = lambda name: F.array_join(F.transform(F.filter(
        "l", lambda x: x["part"] == name), lambda x: x["text"]), " ")
    return (best.groupBy("call_id").agg(
        F.array_sort(F.collect_list(F.struct("turn_index", "part", "text"))).alias("l"))
        .select("call_id", F.concat(F.lit("Issue: "), joined("issue"),
                                    F.lit("\nResolution: "), joined("resolution"),
                                    F.lit("\nOutcome: "), joined("outcome")).alias("summary")))


# --- quality ----------------------------------------------------------------
def rouge_n(pairs: DataFrame, key: str, n: int = 1) -> DataFrame:
    """Clipped n-gram overlap of `summary` with `reference`: precision, recall, F1."""
    def grams(column):
        w = V.tokens(F.col(column))
        if n == 1:
            return w
        size = lambda w: F.greatest(F.size(w) - n + 1, F.lit(0))
        # the text is cut into words once, not once per gram
        return V.once(w, lambda w: F.when(size(w) > 0, F.transform(
            F.sequence(F.lit(1), F.greatest(size(w), F.lit(1))),
            lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>")))
    side = lambda column, mark: pairs.select(
        key, F.explode(grams(column)).alias("gram"), F.lit(mark).alias("in_summary"))
    counts = (side("summary", 1).unionByName(side("reference", 0)).groupBy(key, "gram").agg(
        F.sum("in_summary").alias("s"), F.sum(1 - F.col("in_summary")).alias("r")))
    totals = counts.groupBy(key).agg(F.sum(F.least("s", "r")).alias("overlap"),
                                     F.sum("s").alias("s"), F.sum("r").alias("r"))
    p, r = F.try_divide("overlap", "s"), F.try_divide("overlap", "r")
    zero = F.lit(0.0)
    out = totals.select(key, F.coalesce(p, zero).alias("precision"),
                        F.coalesce(r, zero).alias("recall"))
    return out.withColumn("f1", F.coalesce(F.try_divide(
        F.lit(2.0) * F.col("precision") * F.col("recall"),
        F.col("precision") + F.col("recall")), zero))


def _lcs_length(a, b):
    """Longest common subsequence, one bit per element of `a`."""
    where = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hits = row & where.get(y, 0)
        row = ((row + hits) | (row - hits)) & full
    return len(a) - bin(row).count("1")


def rouge_l(pairs: DataFrame, key: str) -> DataFrame:
    """Longest common subsequence of words: precision, recall, F1."""
    @F.pandas_udf("int")
    def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_lcs_length(list(x), list(y)) for x, y in zip(a, b)], dtype="int32")

    s, r = V.tokens(F.col("summary")), V.tokens(F.col("reference"))
    out = pairs.select(key, lcs(s, r).alias("lcs"), F.size(s).alias("s"), F.size(r).alias("r"))
    zero = F.lit(0.0)
    out = out.select(key, F.coalesce(F.try_divide("lcs", "s"), zero).alias("precision"),
                     F.coalesce(F.try_divide("lcs", "r"), zero).alias("recall"))
    return out.withColumn("f1", F.coalesce(F.try_divide(
        F.lit(2.0) * F.col("precision") * F.col("recall"),
        F.col("precision") + F.col("recall")), zero))


def coverage(turns: DataFrame, summaries: DataFrame) -> DataFrame:
    """Share of the facts of a call (products and issues) that its summary mentions."""
    # the text is lower-cased once, not once per word that is looked for
    facts = lambda text: V.once(F.lower(text), lambda low: F.concat(
        F.transform(T.products_in(low), lambda p: F.concat(F.lit("product:"), p)),
        F.transform(T.issues_in(low), lambda i: F.concat(F.lit("issue:"), i))))
    side = lambda df, column: (df.select("call_id", F.explode(facts(F.col(column))).alias("fact"))
                               .distinct())
    stated = side(summaries, "summary").withColumn("covered", F.lit(True))
    return (side(turns, "text").join(stated, ["call_id", "fact"], "left")
            .groupBy("call_id").agg(
                F.count(F.lit(1)).alias("n_facts"),
                F.count_if(F.col("covered").isNotNull()).alias("n_covered"))
            .withColumn("coverage", F.col("n_covered") / F.col("n_facts")))


def query_focused_turns(turns: DataFrame, question: str, k: int = 3) -> DataFrame:
    """Per call, the turns closest to one question by TF-IDF."""
    spark = turns.sparkSession
    asked = spark.createDataFrame([(0, question)], "query_id int, query_text string")
    # an id that several calls share has one document
    keyed = turns.groupBy(F.struct("call_id", "turn_index").alias("turn_key")).agg(F.collect_list("text").alias("texts"))
    scored = keyword_scores(asked, "query_id", "query_text", keyed, "turn_key", "texts")
    hits = scored.select("turn_key.call_id", "turn_key.turn_index", "score")
    return O.rank_results(hits, ["call_id"], "score", "turn_index", k)


def summary_reuse(requests: DataFrame, stored: DataFrame,
                  days: int = K.SUMMARY_TTL_DAYS) -> DataFrame:
    """Requests answered by a stored summary of the same call and quality that is
    not older than `days`; the others must be computed.

    Each request comes out once, with the newest summary stored at or before it
    as `created_at`.  Requests and stored times are put in one order per call and
    quality, so the work grows with their sum, not their product.
    """
    s = stored.select("call_id", "quality", "created_at", F.col("created_at").alias("__at"),
                      F.lit(0).alias("__kind"))
    asked = requests.withColumn("__at", F.col("requested_at")).withColumn("__kind", F.lit(1))
    w = Window.partitionBy("call_id", "quality").orderBy("__at", "__kind") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = asked.unionByName(s, allowMissingColumns=True).withColumn(
        "created_at", F.last("created_at", ignorenulls=True).over(w))
    fresh = F.col("requested_at") < F.col("created_at") + F.expr(f"INTERVAL '{days}' DAY")
    return (both.filter("__kind = 1").drop("__at", "__kind")
            .withColumn("reused", F.coalesce(fresh, F.lit(False))))


def sentences(turns: DataFrame) -> DataFrame:
    """One row per sentence, numbered through the whole call (`pos`), in blocks of turns."""
    marked = F.regexp_replace(F.col("text"), r"([.!?])\s+", "$1\n")
    split = (turns.select("call_id", "turn_index", "speaker", F.posexplode(
        F.split(marked, "\n")).alias("at", "text"))
        .withColumn("text", X.squeeze(F.col("text"))).filter(F.col("text") != "")
        .withColumn("place", F.col("turn_index").cast("bigint") * SENTENCE_STRIDE + F.col("at")))
    return dense_position(split, ["call_id"], "place", "pos",
                          size=SENTENCE_STRIDE * TURN_BLOCK)


SENTENCE_STRIDE = 1 << 20


def importance_sentences(turns: DataFrame, k: int = 10) -> DataFrame:
    """The k most important sentences of each call, in their order."""
    rows = sentences(turns).filter(~X.is_greeting(F.col("text"))
                                   & ~X.any_pattern(F.col("text"), K.PROCEDURAL_RX))
    scored = turn_tfidf_score(rows, 1000, index="pos")
    n = rows.groupBy("call_id").agg((F.max("pos") + 1).alias("n"))
    text = F.col("text")
    score = (F.col("tfidf_score") + X.position_score(F.col("pos"), F.col("n"))
             + _bonus(T.is_customer(F.col("speaker")), 0.3)
             + _bonus(T.any_of(F.lower(text), K.HIGH_KEYWORDS), 0.5)
             + _bonus(X.has_negative_words(text), 0.2))
    ranked = O.rank_results(scored.join(n, "call_id").withColumn("score", F.round(score, 6)),
                            ["call_id"], "score", "pos", k)
    return ranked.select("call_id", "pos", "speaker", "text", "score")
