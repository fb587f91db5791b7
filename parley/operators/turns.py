"""Ordered logic inside a call: trimming, repetitions, runs, selection, chunking."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley import constants as K
from parley.functions import text as X
from parley.functions import vectors as V
from parley.plans.ordered import (block_of, dense_position, edge_window, fold, part_of,
                                  running_total, with_edges, without_edges)
from parley.plans.workspace import spread, written

CALL = ["call_id"]


# --- row filters ------------------------------------------------------------
def drop_short_turns(turns: DataFrame, at_least: int = 3) -> DataFrame:
    return turns.filter(X.word_count(F.col("text")) >= at_least)


def filter_procedural(turns: DataFrame, aggressive: bool = False,
                      patterns=K.PROCEDURAL_RX) -> DataFrame:
    return turns.filter(X.is_substantial(F.col("text"), aggressive, patterns))


def drop_hold_turns(turns: DataFrame) -> DataFrame:
    return turns.filter(~X.is_hold(F.col("text")))


def drop_greetings_simple(turns: DataFrame) -> DataFrame:
    return turns.filter(~X.is_short_greeting(F.col("text")))


def drop_procedural_simple(turns: DataFrame) -> DataFrame:
    return turns.filter(X.is_not_procedural_simple(F.col("text")))


# --- opening and closing ----------------------------------------------------
def trim_opening_closing(turns: DataFrame) -> DataFrame:
    """Cut greetings at both ends of calls with six or more turns.

    The bounds come from one aggregate per call (first and last turn that is
    not a greeting), so no ordering of the call is needed.
    """
    index, content = F.col("turn_index"), ~X.is_greeting(F.col("text"))
    bounds = turns.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(content, index)).alias("first"),
        F.max(F.when(content, index)).alias("last"))
    first = F.when(F.col("first") < 5, F.col("first")).otherwise(0)
    last = F.when(F.col("last") >= F.col("n") - 5, F.col("last")).otherwise(F.col("n") - 1)
    return _inside(turns, bounds, first, last)


def trim_opening_closing_prefix(turns: DataFrame, at_most: int = 4) -> DataFrame:
    """Cut the leading run of greetings and the trailing run of closings."""
    index, text = F.col("turn_index"), F.col("text")
    bounds = turns.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(~X.is_greeting_full(text), index)).alias("first"),
        F.max(F.when(~X.is_closing(text), index)).alias("last"))
    leading = F.least(F.coalesce("first", "n"), F.lit(at_most))
    trailing = F.least(F.col("n") - 1 - F.coalesce("last", F.lit(-1)), F.lit(at_most))
    return _inside(turns, bounds, leading, F.col("n") - 1 - trailing)


def _inside(turns: DataFrame, bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    keep = bounds.select("call_id", F.when(F.col("n") >= 6, first).otherwise(0).alias("__first"),
                         F.when(F.col("n") >= 6, last).otherwise(F.col("n") - 1).alias("__last"))
    return (turns.join(spread(keep), "call_id")
            .filter(F.col("turn_index").between(F.col("__first"), F.col("__last")))
            .drop("__first", "__last"))


# --- repetitions ------------------------------------------------------------
@lru_cache(maxsize=16)
def _trigram_set(text):
    """Kept for the last texts, as a turn meets the ones kept before it."""
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _alike(a, b, threshold):
    """Whether the Jaccard similarity is above the threshold; the sizes alone may rule it out."""
    if not a or not b or min(len(a), len(b)) / max(len(a), len(b)) <= threshold:
        return False
    shared = len(a & b)
    return shared / (len(a) + len(b) - shared) > threshold


def remove_repetitions(turns: DataFrame, threshold: float = 0.85, look_back: int = 3,
                       bound: DataFrame | None = None) -> DataFrame:
    """Drop turns too similar to one of the speaker's last kept turns.

    Keeping a turn depends on what was kept before, hence a fold per call and
    speaker.  `bound` is a cheaper table with at least the same positions.
    """
    def step(kept, text):
        grams = _trigram_set(text)
        if any(_alike(grams, _trigram_set(k), threshold) for k in kept):
            return kept, False
        return [*kept, text][-look_back:], True

    keyed = turns.withColumn("__speaker", F.lower("speaker"))
    out = fold(keyed, ["call_id", "__speaker"], "turn_index", ["text"], step, [], "__keep",
               bound=bound)
    return out.filter("__keep").drop("__keep", "__speaker")


def remove_repetitions_lag(turns: DataFrame, threshold: float = 0.85,
                           position: str = "turn_index") -> DataFrame:
    """Variant: compare with the three turns before, whether kept or not."""
    grams = turns.withColumn("__grams", X.trigram_codes(F.col("text")))
    edged = with_edges(grams, position, before=3)
    w = edge_window(CALL, position)
    similar = F.lit(False)
    for i in (1, 2, 3):
        same = F.lag("speaker", i).over(w) == F.col("speaker")
        similar = similar | F.coalesce(
            same & (X.jaccard(F.col("__grams"), F.lag("__grams", i).over(w)) > threshold),
            F.lit(False))
    return (without_edges(edged.withColumn("__similar", similar)).filter(~F.col("__similar"))
            .drop("__similar", "__grams"))


def _pair_cosine(a, b):
    """Cosine of the TF-IDF vectors of a two-document collection."""
    import math
    both = set(a) & set(b)
    rare = math.log(3 / 2) + 1
    weight = lambda doc: {t: n * (1.0 if t in both else rare) for t, n in doc.items()}
    x, y = weight(a), weight(b)
    size = math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))
    return sum(x[t] * y[t] for t in both) / size if size else 0.0


def dedupe_customer_turns(turns: DataFrame, threshold: float = 0.8,
                          look_back: int = 3) -> DataFrame:
    """Variant: only customer turns, compared by token cosine with kept ones."""
    def step(kept, tokens):
        counts = {}
        for t in tokens:
            counts[t] = counts.get(t, 0) + 1
        if any(_pair_cosine(counts, k) > threshold for k in kept):
            return kept, False
        return [*kept, counts][-look_back:], True

    customer = F.col("speaker") == "customer"
    tokens = turns.filter(customer).withColumn("__tokens", V.tokens(F.col("text")))
    kept = fold(tokens, CALL, "turn_index", ["__tokens"], step, [], "__keep")
    return (kept.filter("__keep").drop("__keep", "__tokens")
            .unionByName(turns.filter(~customer)))


# --- speaker runs -----------------------------------------------------------
def speaker_runs(turns: DataFrame, position: str = "turn_index",
                 part_turns: int | None = None) -> DataFrame:
    """Merge consecutive turns of one speaker: (call_id, run, part, speaker, run_text).

    With `part_turns` a longer run is cut into parts of so many turns, counted
    from its own first turn; otherwise every run is part 0.
    """
    edged = with_edges(turns, position, before=1)
    w = edge_window(CALL, position)
    starts = without_edges(edged.withColumn("__new", F.coalesce(
        F.lag("speaker").over(w) != F.col("speaker"), F.lit(True)).cast("int")))
    runs = running_total(starts, CALL, position, F.col("__new"), "run", bound=turns)
    from_start = F.lit(0)
    if part_turns:
        first = runs.groupBy("call_id", "run").agg(F.min(position).alias("__first"))
        runs = runs.join(first, ["call_id", "run"])
        from_start = F.col(position) - F.col("__first")
    packed = runs.groupBy("call_id", "run", part_of(from_start, part_turns).alias("part"), "speaker").agg(
        F.collect_list(F.struct(F.col(position).alias("i"), F.col("text").alias("t")))
        .alias("l"))
    return packed.select("call_id", "run", "part", "speaker", F.array_join(
        F.transform(F.array_sort("l"), lambda x: x["t"]), " ").alias("run_text"))


def run_summary(turns: DataFrame) -> DataFrame:
    """`speaker: text` runs joined to one text per call; the input is a selection
    within a word budget.
    """
    packed = turns.groupBy("call_id").agg(
        F.sort_array(F.collect_list(F.struct("turn_index", "speaker", "text"))).alias("l"))
    before = lambda i: F.get(F.col("l"), i - 1)["speaker"]
    piece = lambda x, i: F.concat(
        F.when(i == 0, F.lit("")).otherwise(F.lit(" ")),
        F.when((i > 0) & (before(i) == x["speaker"]), F.lit(""))
        .otherwise(F.concat(x["speaker"], F.lit(": "))), x["text"])
    return packed.select("call_id",
                         F.array_join(F.transform("l", piece), "").alias("summary_text"))


# --- selection under a budget -----------------------------------------------
def sized_turns(turns: DataFrame) -> DataFrame:
    """Turns with `__words`, the length that the selection reads; kept where it is there already."""
    return turns if "__words" in turns.columns else turns.withColumn("__words", X.word_count(F.col("text")))


def extractive_select(scored: DataFrame, target: int, keys=("call_id",),
                      index: str = "turn_index", score: str = "score") -> DataFrame:
    """Best turns first, each taken when it still fits the word budget.

    At most `target / w` turns of length `w` can ever be taken, so per call and
    length only the best that many are candidates; the rank limit runs before
    the shuffle.  That bounds the greedy pass by about `target * ln(target)`
    rows however long the call is.  Turns without words always fit.
    """
    keys = list(keys)
    sized = sized_turns(scored)
    w = Window.partitionBy(*keys, "__words").orderBy(F.desc(score), index)
    fitting = (sized.filter(F.col("__words").between(1, target))
               .withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= target)
               .filter(F.col("__rank") * F.col("__words") <= target))
    best_first = F.sort_array(F.collect_list(F.struct(
        (-F.col(score)).alias("s"), F.col(index).alias("i"), F.col("__words").alias("w"))))
    start = F.struct(F.lit(0).alias("used"), F.array().cast("array<int>").alias("taken"))
    chosen = fitting.groupBy(*keys).agg(best_first.alias("l")).select(*keys, F.explode(
        F.aggregate("l", start, lambda s, x: F.when(
            s["used"] + x["w"] <= target,
            F.struct((s["used"] + x["w"]).alias("used"),
                     F.array_append(s["taken"], x["i"].cast("int")).alias("taken")))
            .otherwise(s))["taken"]).alias(index))
    picked = sized.join(spread(chosen), [*keys, index], "left_semi")
    return picked.unionByName(sized.filter(F.col("__words") == 0)).drop("__words")


def context_budget(ranked: DataFrame, keys, order: str, tokens: Column,
                   budget: int = K.CONTEXT_TOKENS) -> DataFrame:
    """Take items in rank order and stop at the first that overflows.

    For retrieval results: a group is the top k of one question.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (ranked.withColumn("__used", F.sum(tokens).over(w))
            .filter(F.col("__used") <= budget).drop("__used"))


# --- chunking ---------------------------------------------------------------
def fixed_chunks(docs: DataFrame, key: str, text: str = "text", size: int = 500,
                 overlap: int = 0) -> DataFrame:
    """Every `size - overlap` words a chunk of up to `size` words."""
    step = size - overlap
    w = docs.select(key, X.words(F.col(text)).alias("__w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("__w") - 1, F.lit(0)), F.lit(step))
    return (w.filter(F.size("__w") > 0)
            .select(key, "__w", F.posexplode(starts).alias("chunk_index", "__s"))
            .select(key, "chunk_index", F.array_join(F.slice("__w", F.col("__s") + 1, size), " ")
                    .alias("chunk_text")))


def pause_gap(turns: DataFrame, position: str = "turn_index") -> DataFrame:
    """Silence before each turn; above five seconds it marks a topic change."""
    edged = with_edges(turns, position, before=1)
    gap = F.col("start_time") - F.lag("end_time").over(edge_window(CALL, position))
    out = without_edges(edged.withColumn("gap_seconds", gap))
    return out.withColumn("is_pause", F.coalesce(F.col("gap_seconds") > 5, F.lit(False)))


def adjacent_cosine(turns: DataFrame, position: str = "turn_index",
                    after: int = 1) -> DataFrame:
    """Similarity of each turn to the next, from token-count vectors.

    The vectors are the built-in hashed embedding of each text.
    """
    vec = turns.withColumn("__vec", V.hashed_embedding(F.col("text")))
    edged = with_edges(vec, position, before=1, after=after)
    sim = F.round(V.dot(F.col("__vec"),
                        F.lead("__vec").over(edge_window(CALL, position))), 6)
    return edged.withColumn("next_similarity", sim).drop("__vec")


def topic_boundaries(turns: DataFrame, threshold: float = 0.6,
                     position: str = "turn_index") -> DataFrame:
    """Number topic segments; a turn closes one on low similarity or a marker."""
    sim = adjacent_cosine(turns, position)
    w = edge_window(CALL, position)
    closes = F.col("next_similarity").isNotNull() & (
        (F.col("next_similarity") < threshold)
        | F.col("text").rlike("(?i)" + K.TOPIC_MARKER_RX))
    opened = sim.withColumn("__closes", closes.cast("int"))
    opened = without_edges(opened.withColumn(
        "__opens", F.coalesce(F.lag("__closes").over(w), F.lit(0))))
    return (running_total(opened, CALL, position, F.col("__opens"), "segment", bound=turns)
            .drop("__closes", "__opens"))


def semantic_chunks(turns: DataFrame, threshold: float = 0.65, window: int = 3,
                    position: str = "turn_index") -> DataFrame:
    """Number chunks; turn i+1 opens one when similarities i..i+2 average low.

    The window must lie inside the call: the last possible start is the one
    before the last full window, as the documented loop runs.
    """
    sim = adjacent_cosine(turns, position, after=window + 1)
    w = edge_window(CALL, position)
    ahead = w.rowsBetween(0, window - 1)
    mean = F.sum("next_similarity").over(ahead) / F.lit(float(window))
    whole = F.lead("next_similarity", window).over(w).isNotNull()
    low = sim.withColumn("__low", (whole & (F.round(mean, 6) < threshold)).cast("int"))
    opened = without_edges(low.withColumn("__opens",
                                          F.coalesce(F.lag("__low").over(w), F.lit(0))))
    return (running_total(opened, CALL, position, F.col("__opens"), "segment", bound=turns)
            .drop("__low", "__opens"))


def segment_table(chunked: DataFrame, scores: Column | None = None) -> DataFrame:
    """One row per (call, segment): bounds, words, importance."""
    score = scores if scores is not None else F.lit(0.0)
    return chunked.groupBy("call_id", "segment").agg(
        F.min("turn_index").alias("first_turn"), F.max("turn_index").alias("last_turn"),
        F.sum(X.word_count(F.col("text"))).alias("n_words"),
        F.max(score).alias("importance_score"),
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))


def merge_small_segments(segments: DataFrame, max_words: int) -> DataFrame:
    """Join neighbouring segments while they fit together in `max_words`."""
    def step(used, n_words):
        n_words = int(n_words)
        if used is not None and used + n_words <= max_words:
            return used + n_words, False
        return n_words, True

    segments = written(segments, "segments")
    opened = fold(segments, CALL, "segment", ["n_words"], step, None, "__opens")
    return (running_total(opened, CALL, "segment", F.col("__opens").cast("int"), "chunk", bound=segments)
            .drop("__opens").withColumn("chunk", F.col("chunk") - 1))


def merged_segments(merged: DataFrame) -> DataFrame:
    """One row per merged chunk."""
    return merged.groupBy("call_id", "chunk").agg(
        F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"),
        F.sum("n_words").alias("n_words"), F.max("importance_score").alias("importance_score"),
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))


def with_turn_counts(turns: DataFrame) -> DataFrame:
    """Every turn with the number of turns in its call (`n_turns`)."""
    n = turns.groupBy("call_id").agg(F.count(F.lit(1)).alias("n_turns"))
    return turns.join(n, "call_id")


def call_phases(turns: DataFrame) -> DataFrame:
    ratio = F.col("turn_index") / F.col("n_turns").cast("double")
    phase = (F.when(ratio < 0.1, "opening").when(ratio > 0.85, "closing")
             .when(X.is_resolution(F.col("text")), "resolution").otherwise("investigation"))
    return with_turn_counts(turns).withColumn("phase", phase)


def topic_label(chunked: DataFrame) -> DataFrame:
    """The two most frequent alphabetic words over four letters, joined by `_`."""
    word = chunked.select("call_id", "segment", "turn_index", F.posexplode(
        F.split(F.lower("text"), r"\s+")).alias("at", "word"))
    word = word.filter(F.col("word").rlike(r"^\p{L}{5,}$"))
    counts = word.groupBy("call_id", "segment", "word").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("turn_index", "at")).alias("first_at"))
    w = Window.partitionBy("call_id", "segment").orderBy(F.desc("n"), "first_at")
    best = counts.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= 2)
    return best.groupBy("call_id", "segment").agg(F.concat_ws(
        "_", F.max(F.when(F.col("r") == 1, F.col("word"))),
        F.max(F.when(F.col("r") == 2, F.col("word")))).alias("topic"))


def rank_results(scored: DataFrame, keys, score: str, tie: str, k: int | None = None) -> DataFrame:
    """Rank from 1 per query; with `k`, the limit is applied before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    out = scored.withColumn("rank", F.row_number().over(w))
    return out.filter(F.col("rank") <= k) if k else out


def renumber(turns: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """Dense positions after turns were dropped; `bound` is a cheaper table with at least the same turns."""
    return dense_position(turns, CALL, "turn_index", "pos", bound=bound)
