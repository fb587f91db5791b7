"""Turn scoring, call roll-up, and everything asked of the call tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley import constants as K
from parley.functions import triage as T
from parley.functions.text import period_trunc
from parley.plans.workspace import spread
from parley.sources.transcripts import segment_id


# --- turn scoring -----------------------------------------------------------
def analyze_segments(turns: DataFrame) -> DataFrame:
    """All turn-level rules as one narrow projection.

    Keywords are counted separately from the keyword lists, so that consumers
    of the score alone never build the lists.
    """
    text, low = F.col("text"), F.lower("text")
    scored = (turns.withColumn("intent", T.classify_intent(text))
              .withColumn("sentiment", T.analyze_sentiment(text))
              .withColumn("high_priority_keywords", T.high_keywords(text))
              .withColumn("medium_priority_keywords", T.medium_keywords(text))
              .withColumn("products_mentioned", T.extract_products(text))
              .withColumn("issues_mentioned", T.extract_issues(text)))
    scored = scored.withColumn("importance_score", T.importance_score(
        F.col("intent"), F.col("sentiment"), T.number_found(low, K.HIGH_KEYWORDS),
        T.number_found(low, K.MEDIUM_KEYWORDS), T.is_customer(F.col("speaker"))))
    score = F.col("importance_score")
    return scored.select(
        segment_id().alias("segment_id"), "call_id", "turn_index", "speaker", "text", "intent",
        "sentiment", "importance_score", T.requires_model(score).alias("requires_llm_enrichment"),
        T.is_critical(score).alias("is_critical"), "high_priority_keywords",
        "medium_priority_keywords", "products_mentioned", "issues_mentioned")


# --- call roll-up -----------------------------------------------------------
def micro(score: Column) -> Column:
    """A score in millionths, so that sums are exact in any order and at any length."""
    return F.round(score * 1_000_000).cast("bigint")


def units(score: Column) -> Column:
    """A score in [0, 1] as whole units of 2^-60, which doubles from 2^-8 on are made of.

    Sums of units are exact in any order; `mean_score` rounds once.
    """
    return (score * F.lit(2.0 ** 60)).cast("bigint")


def mean_score(total: Column, n: Column) -> Column:
    """The mean of scores from their sum in `units`; NULL without scores."""
    return F.try_divide(total.cast("double") / F.lit(2.0 ** 60), n)


def weighted_score(customer: Column, n_customer: Column, agent: Column,
                   n_agent: Column) -> Column:
    """The two sides' mean scores by their shares, from sums of units; not rounded, as levels are compared with it."""
    mean = lambda total, n: F.coalesce(mean_score(total, n), F.lit(0.0))
    return mean(customer, n_customer) * F.lit(K.CUSTOMER_SHARE) + mean(agent, n_agent) * F.lit(K.AGENT_SHARE)


def _worst(severity: Column, label: Column, labels) -> Column:
    """One number that grows with severity, then with the earlier turn, and holds the label."""
    place = F.array_position(F.array(*map(F.lit, labels)), label)
    earlier = F.lit((1 << 32) - 1) - F.col("turn_index").cast("bigint")
    return ((severity.cast("bigint") + 8) * F.lit(1 << 40) + earlier * 256 + place).cast("bigint")


def _label(code: Column, labels) -> Column:
    return F.get(F.array(*map(F.lit, labels)), (code % 256 - 1).cast("int"))


SIDES = ("all", "c", "a")
LOW_BITS = 30


def turn_numbers(segments: DataFrame, *keep: str) -> DataFrame:
    """What a roll-up adds and compares of each scored turn, as whole numbers, and the columns to `keep`.

    Scores in units are cut into upper and lower bits, which are added apart as longs: up to 2^33 turns of a call.
    """
    speaker, score = F.lower("speaker"), units(F.col("importance_score"))
    numbers = segments.select(
        "call_id", *keep, "is_critical", score.alias("all"), F.when(speaker == "customer", score).alias("c"),
        F.when(speaker == "agent", score).alias("a"),
        _worst(T.intent_severity(F.col("intent")), F.col("intent"), K.INTENTS).alias("i"),
        _worst(T.sentiment_severity(F.col("sentiment")), F.col("sentiment"), K.SENTIMENTS).alias("s"))
    return numbers.select(
        "call_id", *keep, "is_critical", "i", "s", *[F.shiftright(x, LOW_BITS).alias(f"{x}_up") for x in SIDES],
        *[F.col(x).bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint")).alias(f"{x}_low") for x in SIDES])


def roll_up_calls(segments: DataFrame, *also: Column) -> DataFrame:
    """One row per call (and `also`, such as a session): level, overall intent and sentiment, triage decision.

    Everything is a sum or a maximum of whole numbers: the turns of a call are
    combined per task before the shuffle, and the result does not depend on
    their order or number.  The stream uses the same arithmetic.
    """
    return roll_up_numbers(turn_numbers(segments), *also)


def roll_up_numbers(numbers: DataFrame, *also: Column) -> DataFrame:
    """`roll_up_calls` from `turn_numbers`."""
    calls = numbers.groupBy("call_id", *also).agg(
        F.max("i").alias("i"), F.max("s").alias("s"),
        F.count_if("is_critical").alias("n_critical"), F.count(F.lit(1)).alias("n_all"),
        *[F.sum(f"{x}_{bits}").alias(f"{x}_{bits}") for x in SIDES for bits in ("up", "low")],
        F.count("c_up").alias("nc"), F.count("a_up").alias("na"))
    whole = lambda x: F.col(f"{x}_up").cast("decimal(20,0)") * F.lit(1 << LOW_BITS) + F.col(f"{x}_low")
    calls = calls.withColumns({x: whole(x) for x in SIDES})
    calls = calls.withColumn("weighted_score", weighted_score(
        F.col("c"), F.col("nc"), F.col("a"), F.col("na"))) \
        .withColumn("overall_intent", _label(F.col("i"), K.INTENTS)) \
        .withColumn("overall_sentiment", _label(F.col("s"), K.SENTIMENTS))
    calls = calls.withColumn("overall_importance", T.importance_level(F.col("weighted_score")))
    calls = calls.withColumn("requires_enrichment", requires_enrichment(
        F.col("overall_importance"), F.col("n_critical")))
    return calls.select(
        "call_id", "overall_intent", "overall_sentiment", "overall_importance",
        mean_score(F.col("all"), F.col("n_all")).alias("importance_score"),
        "weighted_score", "requires_enrichment",
        enrichment_reason(F.col("overall_importance"), F.col("overall_intent"),
                          F.col("n_critical")).alias("enrichment_reason"),
        F.col("n_all").cast("int").alias("total_segments"),
        F.col("n_critical").cast("int").alias("high_priority_segments"))


def requires_enrichment(level: Column, n_critical: Column) -> Column:
    return level.isin("critical", "high") | (n_critical >= K.MIN_CRITICAL_SEGMENTS)


def enrichment_reason(level: Column, intent: Column, n_critical: Column) -> Column:
    return F.when(requires_enrichment(level, n_critical), F.when(
        level == "critical", K.REASON_CRITICAL).when(
        intent == "complaint", K.REASON_COMPLAINT).when(
        n_critical >= K.MIN_CRITICAL_SEGMENTS,
        F.format_string(K.REASON_SEGMENTS, n_critical.cast("bigint"))))


# --- filters ----------------------------------------------------------------
def date_range_filter(df: DataFrame, start=None, end=None, column="call_timestamp") -> DataFrame:
    """Inclusive bounds; a missing bound does not restrict."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end).cast("timestamp_ntz"))
    return df


def metadata_filter(df: DataFrame, filters: dict) -> DataFrame:
    """Scalars are equality, lists are membership, unknown keys match nothing."""
    for key, value in (filters or {}).items():
        if key == "date_range":
            df = date_range_filter(df, value.get("start"), value.get("end"))
        elif key not in df.columns:
            df = df.filter(F.lit(False))
        elif isinstance(value, (list, tuple, set)):
            df = df.filter(F.col(key).isin(*value))
        else:
            df = df.filter(F.col(key) == value)
    return df


def complaint_class(df: DataFrame) -> DataFrame:
    return df.filter(F.col("overall_intent").isin(*K.COMPLAINT_INTENTS))


# --- joins ------------------------------------------------------------------
def with_results(calls: DataFrame, pc: DataFrame, how: str = "inner") -> DataFrame:
    """Calls next to their preprocessing results."""
    return calls.join(pc, "call_id", how)


QUERY_FILTERS = {"product": "product", "client_segment": "client_segment",
                 "intent": "overall_intent", "sentiment": "overall_sentiment",
                 "importance": "overall_importance"}


def matching_calls(calls: DataFrame, pc: DataFrame, filters: dict | None = None) -> DataFrame:
    """Calls (with or without results) that meet all filters."""
    found = with_results(calls, pc, "left")
    for name, column in QUERY_FILTERS.items():
        if filters and name in filters:
            found = found.filter(F.col(column) == filters[name])
    bounds = (filters or {}).get("date_range", {})
    return date_range_filter(found, bounds.get("start"), bounds.get("end"))


def query_calls(calls: DataFrame, pc: DataFrame, filters: dict | None = None,
                limit: int = 100) -> DataFrame:
    """The newest matching calls."""
    return newest(matching_calls(calls, pc, filters).select(
        "call_id", "product", "client_segment", "call_timestamp", "call_duration_seconds",
        "overall_intent", "overall_sentiment", "overall_importance", "importance_score"), limit)


def newest(calls: DataFrame, limit: int) -> DataFrame:
    return calls.orderBy(F.desc("call_timestamp"), "call_id").limit(limit)


def enrichment_queue(pc: DataFrame, enriched: DataFrame, limit: int | None = None) -> DataFrame:
    """Flagged calls that are not enriched yet, critical ones first."""
    queue = (pc.filter("requires_enrichment")
             .join(spread(enriched.select("call_id")), "call_id", "left_anti"))
    if limit:
        queue = queue.orderBy(T.level_order(F.col("overall_importance")), "call_id").limit(limit)
    return queue


def nested_segments(segments: DataFrame) -> DataFrame:
    """(call_id, segments): each call's scored turns in order, as one array."""
    one = F.struct("turn_index", "segment_id", "speaker", "text", "intent", "sentiment",
                   "importance_score")
    return segments.groupBy("call_id").agg(F.array_sort(F.collect_list(one)).alias("segments"))


def call_details(calls: DataFrame, pc: DataFrame, enrichments: DataFrame,
                 segments: DataFrame) -> DataFrame:
    """Metadata, results, enrichment and ordered segments of each call; what is missing is null."""
    return (calls.join(pc, "call_id", "left").join(enrichments, "call_id", "left")
            .join(nested_segments(segments), "call_id", "left")
            .withColumn("num_segments", F.coalesce(F.size("segments"), F.lit(0))))


def call_lookup(call_ids, calls: DataFrame, pc: DataFrame, enrichments: DataFrame,
                segments: DataFrame) -> DataFrame:
    """The details of the calls asked for: a list of ids, or a table with a column call_id.

    Every table is cut to these calls before it is joined; the filter of a list reaches the
    scans.
    """
    if isinstance(call_ids, DataFrame):
        ids = call_ids.select("call_id").distinct()
        only = lambda df: df.join(ids, "call_id", "left_semi")
    else:
        only = lambda df: df.filter(F.col("call_id").isin(list(call_ids)))
    return call_details(*map(only, (calls, pc, enrichments, segments)))


def search_documents_base(segments: DataFrame, enrichments: DataFrame,
                          calls: DataFrame) -> DataFrame:
    return (segments.select("segment_id", "call_id", "speaker", "text", "intent", "sentiment",
                            "importance_score")
            .join(spread(enrichments.select("call_id", "summary", "key_issues", "semantic_tags")),
                  "call_id", "left")
            .join(calls.select("call_id", "product", "client_segment", "call_timestamp"),
                  "call_id"))


SECONDS_30D = 30 * 86400
WEEK = 7 * 86400


def related_calls(calls: DataFrame, k: int = 3) -> DataFrame:
    """For every call the latest `k` calls of the same client in the 7 days before.

    Cut into client-weeks; a week also sees the last `k` calls of the week
    before, which is all that can reach into it.
    """
    second = F.unix_seconds(F.col("call_timestamp").cast("timestamp"))
    rows = calls.select("client_id", "call_id", "call_timestamp", second.alias("sec"),
                        F.floor(second / WEEK).alias("week"))
    tail = Window.partitionBy("client_id", "week").orderBy(F.desc("call_timestamp"),
                                                           F.desc("call_id"))
    carried = (rows.withColumn("r", F.row_number().over(tail)).filter(F.col("r") <= k).drop("r")
               .withColumn("week", F.col("week") + 1).withColumn("carried", F.lit(True)))
    w = Window.partitionBy("client_id", "week").orderBy("call_timestamp", "call_id")
    before = [F.struct(F.lag("call_id", i).over(w).alias("related_call_id"),
                       F.lag("sec", i).over(w).alias("s"), F.lit(i).alias("position"))
              for i in range(1, k + 1)]
    return (rows.withColumn("carried", F.lit(False)).unionByName(carried)
            .withColumn("before", F.array(*before)).filter(~F.col("carried"))
            .select("call_id", "sec", F.explode("before").alias("b"))
            .filter(F.col("b.s") >= F.col("sec") - WEEK)
            .select("call_id", "b.related_call_id", "b.position"))


def previous_calls(calls: DataFrame) -> DataFrame:
    """How many calls the client made in the 30 days before, as call context.

    Counts are first reduced to one row per client and second, which bounds the
    rows of a client inside two adjacent 30-day buckets.
    """
    second = F.unix_seconds(F.col("call_timestamp").cast("timestamp"))
    keyed = calls.withColumn("sec", second)
    per_second = keyed.groupBy("client_id", "sec").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.floor(F.col("sec") / SECONDS_30D)
    copies = F.explode(F.array(F.struct(bucket.alias("b"), F.lit(False).alias("old")),
                               F.struct((bucket + 1).alias("b"), F.lit(True).alias("old"))))
    w = Window.partitionBy("client_id", "c.b").orderBy("sec").rangeBetween(-SECONDS_30D, -1)
    counted = (per_second.withColumn("c", copies)
               .withColumn("previous_calls", F.coalesce(F.sum("n").over(w), F.lit(0)))
               .filter(~F.col("c.old")).select("client_id", "sec", "previous_calls"))
    hour = F.hour("call_timestamp")
    part = (F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon")
            .otherwise("evening"))
    return (keyed.join(counted, ["client_id", "sec"])
            .select("call_id", "client_id", F.col("client_segment").alias("customer_tier"),
                    (F.col("call_duration_seconds") / F.lit(60.0)).alias("duration_min"),
                    part.alias("time_of_day"), "previous_calls"))


# --- aggregates -------------------------------------------------------------
def percentage(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), total), digits)


def importance_distribution(pc: DataFrame) -> DataFrame:
    """Calls and share per level, critical first."""
    counts = pc.groupBy("overall_importance").agg(F.count(F.lit(1)).alias("n_calls"))
    total = F.sum("n_calls").over(Window.partitionBy())     # over at most four rows
    return (counts.withColumn("percentage", percentage(F.col("n_calls"), total))
            .orderBy(T.level_order(F.col("overall_importance"))))


def triage_rate(pc: DataFrame) -> DataFrame:
    flagged = F.count_if("requires_enrichment")
    top = F.count_if(F.col("overall_importance").isin("critical", "high"))
    n = F.count(F.lit(1))
    return pc.agg(n.alias("total_calls"), flagged.alias("flagged_calls"),
                  percentage(flagged, n).alias("flagged_pct"),
                  top.alias("critical_high_calls"), percentage(top, n).alias("critical_high_pct"))


def _share_of_calls(counts: DataFrame, calls: DataFrame) -> DataFrame:
    """Attach the share of all calls (a scalar subquery) as a percentage."""
    total = calls.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("percentage", percentage(F.col("n_calls"), total))


def top_complaints(calls: DataFrame, pc: DataFrame, limit: int = 10) -> DataFrame:
    counts = (complaint_class(with_results(calls, pc)).groupBy(
        F.col("overall_intent").alias("category")).agg(F.count(F.lit(1)).alias("n_calls")))
    return top_categories(_share_of_calls(counts, calls), limit)


def top_products(calls: DataFrame, limit: int = 10) -> DataFrame:
    counts = calls.groupBy(F.col("product").alias("category")).agg(
        F.count(F.lit(1)).alias("n_calls"))
    return top_categories(_share_of_calls(counts, calls), limit)


def top_categories(counts: DataFrame, limit: int) -> DataFrame:
    return counts.orderBy(F.desc("n_calls"), "category").limit(limit)


def sentiment_distribution(calls: DataFrame, pc: DataFrame) -> DataFrame:
    return with_results(calls, pc).groupBy("overall_sentiment").agg(
        F.count(F.lit(1)).alias("n_calls"))


CATEGORY_COLUMNS = {"product": ("calls", "product"), "intent": ("pc", "overall_intent"),
                    "sentiment": ("pc", "overall_sentiment"),
                    "importance": ("pc", "overall_importance"), "region": ("calls", "region"),
                    "client_segment": ("calls", "client_segment")}


def count_by_category(calls: DataFrame, pc: DataFrame, category: str,
                      filters: dict | None = None) -> DataFrame:
    """Calls per value of one category, with the share of the counted table."""
    if category not in CATEGORY_COLUMNS:
        raise ValueError(f"Unknown category: {category}")
    table, column = CATEGORY_COLUMNS[category]
    if filters:
        rows = matching_calls(calls, pc, filters)
        if table == "pc":
            rows = rows.filter(F.col("overall_intent").isNotNull())
    else:
        rows = calls if table == "calls" else pc
    counts = rows.groupBy(F.col(column).alias("category")).agg(
        F.count(F.lit(1)).alias("n_calls"))
    total = F.sum("n_calls").over(Window.partitionBy())     # one row per category value
    return (counts.withColumn("percentage", percentage(F.col("n_calls"), total))
            .orderBy(F.desc("n_calls"), "category"))


def latest_periods(per_period: DataFrame, n: int) -> DataFrame:
    """The latest `n` periods, oldest first."""
    return per_period.orderBy(F.desc("period")).limit(n).orderBy("period")


def call_volume_trend(calls: DataFrame, period: str = "daily", n: int = 30) -> DataFrame:
    counts = calls.groupBy(period_trunc(F.col("call_timestamp"), period).alias("period")).agg(
        F.count(F.lit(1)).alias("call_count"))
    return latest_periods(counts, n)


def sentiment_trend(calls: DataFrame, pc: DataFrame, period: str = "daily",
                    n: int = 30) -> DataFrame:
    """One row per period, one column per sentiment."""
    rows = with_results(calls, pc).withColumn(
        "period", period_trunc(F.col("call_timestamp"), period))
    counts = rows.groupBy("period").agg(*[
        F.count_if(F.col("overall_sentiment") == s).alias(s) for s in K.SENTIMENTS])
    return latest_periods(counts, n)


def _entry(metric: str, label: Column, n: Column | None = None) -> Column:
    fields = [F.lit(metric).alias("metric"), label.alias("label")]
    return F.struct(*fields, *([n.alias("n")] if n is not None else []))


def ingestion_statistics(flagged_calls: DataFrame) -> DataFrame:
    """Totals, per segment, per product and per stage, as (metric, label, n)."""
    grouped = (flagged_calls.groupBy("client_segment", "product").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("processed").alias("processed"),
        F.count_if(~F.col("processed")).alias("unprocessed"),
        F.count_if("preprocessed").alias("preprocessed"),
        F.count_if("enriched").alias("enriched")))
    metrics = F.array(
        _entry("total", F.lit("all"), F.col("n")),
        _entry("segment", F.col("client_segment"), F.col("n")),
        _entry("product", F.col("product"), F.col("n")),
        *[_entry("stage", F.lit(s), F.col(s))
          for s in ("processed", "unprocessed", "preprocessed", "enriched")])
    return (grouped.select(F.explode(metrics).alias("m"))
            .groupBy("m.metric", "m.label").agg(F.sum("m.n").alias("n")))


def analytics_summary(calls: DataFrame, pc: DataFrame, start=None, end=None) -> DataFrame:
    """One scan of the joined calls to a small cube, then the summary metrics from it."""
    rows = date_range_filter(with_results(calls, pc, "left"), start, end)
    cube = rows.groupBy("product", "overall_intent", "overall_sentiment").agg(
        F.count(F.lit(1)).alias("n"), F.min("call_timestamp").alias("first_call"),
        F.max("call_timestamp").alias("last_call"))
    return summary_of(cube)


def summary_of(cube: DataFrame) -> DataFrame:
    """The summary metrics from partial counts `n` by product, intent and sentiment."""
    intent, sentiment = F.col("overall_intent"), F.col("overall_sentiment")
    entry = [_entry("total", F.lit("all")), _entry("product", F.col("product")),
             F.when(intent.isin(*K.COMPLAINT_INTENTS), _entry("complaint", intent)),
             F.when(sentiment.isNotNull(), _entry("sentiment", sentiment))]
    exploded = cube.withColumn("m", F.explode(F.array_compact(F.array(*entry))))
    out = exploded.groupBy("m.metric", "m.label").agg(
        F.sum("n").alias("n_calls"), F.min("first_call").alias("first_call"),
        F.max("last_call").alias("last_call"))
    total = F.max(F.when(F.col("metric") == "total", F.col("n_calls"))).over(
        Window.partitionBy())                               # a handful of rows
    return out.withColumn("percentage", percentage(F.col("n_calls"), total))


def system_statistics(flagged_calls: DataFrame, enrichments: DataFrame) -> DataFrame:
    counts = flagged_calls.agg(
        F.count(F.lit(1)).alias("total_calls"), F.count_if("processed").alias("processed"),
        F.count_if("preprocessed").alias("preprocessed"),
        F.count_if("enriched").alias("enriched"))
    cost = enrichments.agg(F.coalesce(exact_sum("cost_usd"), F.lit(0.0))).scalar()
    return counts.withColumn("total_cost", cost).withColumn(
        "avg_cost", F.coalesce(F.try_divide("total_cost", "enriched"), F.lit(0.0)))


def exact_sum(column: str, scale: int = 8) -> Column:
    """Sum of money in decimals: the same whatever order the rows arrive in."""
    return F.sum(F.col(column).cast(f"decimal(30,{scale})")).cast("double")


def cost_by_model(enrichments: DataFrame) -> DataFrame:
    return (enrichments.groupBy("model_used").agg(
        F.count(F.lit(1)).alias("num_calls"), F.sum("tokens_used").alias("total_tokens"),
        exact_sum("cost_usd").alias("total_cost")).orderBy(F.desc("total_cost"), "model_used"))


def enrichment_statistics(enrichments: DataFrame) -> DataFrame:
    """Per model, next to the totals over all models."""
    by_model = cost_by_model(enrichments).select("model_used", "num_calls", "total_cost")
    everything = Window.partitionBy()                       # one row per model
    n, cost = F.sum("num_calls").over(everything), F.sum("total_cost").over(everything)
    return by_model.select("model_used", "num_calls", "total_cost",
                           n.alias("total_enrichments"), cost.alias("total_cost_usd"),
                           F.try_divide(cost, n).alias("avg_cost_per_call"))


def cost_projection(calls: DataFrame, enrichments: DataFrame) -> DataFrame:
    totals = enrichments.agg(F.count(F.lit(1)).alias("n_enriched"),
                             F.coalesce(exact_sum("cost_usd"), F.lit(0.0)).alias("total_cost"))
    out = totals.withColumn("n_calls", calls.agg(F.count(F.lit(1))).scalar()).withColumn(
        "avg_cost", F.coalesce(F.try_divide("total_cost", "n_enriched"), F.lit(0.0)))
    all_calls = F.col("avg_cost") * F.col("n_calls")
    return out.select(
        "n_calls", "n_enriched", "total_cost", "avg_cost",
        (F.col("avg_cost") * F.lit(1000000)).alias("cost_per_million"),
        all_calls.alias("cost_all_calls"), (all_calls - F.col("total_cost")).alias("savings"),
        F.try_divide((all_calls - F.col("total_cost")) * F.lit(100.0), all_calls)
        .alias("savings_pct"))


def dashboard_kpis(calls: DataFrame, pc: DataFrame) -> DataFrame:
    rows = with_results(calls, pc, "left")
    n = F.count(F.lit(1))
    negative = F.count_if(F.col("overall_sentiment").contains("negative"))
    return rows.agg(
        n.alias("total_calls"), F.round(F.try_divide(negative * F.lit(100.0), n), 1)
        .alias("negative_pct"),
        F.count_if(F.col("overall_intent").isin(*K.COMPLAINT_INTENTS)).alias("total_complaints"),
        F.floor((F.unix_seconds(F.max("call_timestamp").cast("timestamp"))
                 - F.unix_seconds(F.min("call_timestamp").cast("timestamp"))) / 86400)
        .cast("bigint").alias("days"))


def product_importance(calls: DataFrame, pc: DataFrame) -> DataFrame:
    return (with_results(calls, pc).groupBy("product").agg(
        F.count(F.lit(1)).alias("call_count"),
        (exact_sum("importance_score", 15) / F.count(F.lit(1))).alias("avg_importance"))
        .orderBy(F.desc("call_count"), "product"))


def importance_trend(calls: DataFrame, pc: DataFrame, period: str = "daily",
                     days: int = 30) -> DataFrame:
    """Calls and mean importance per period over the last `days` days of data."""
    newest_call = calls.agg(F.max("call_timestamp")).scalar()
    recent = with_results(calls.filter(
        F.col("call_timestamp") >= newest_call - F.expr(f"INTERVAL '{days}' DAY")), pc)
    return (recent.groupBy(period_trunc(F.col("call_timestamp"), period).alias("period")).agg(
        F.count(F.lit(1)).alias("call_count"),
        (exact_sum("importance_score", 15) / F.count(F.lit(1))).alias("avg_importance"))
        .orderBy("period"))


def trailing_totals(calls: DataFrame, pc: DataFrame, days=K.TRAILING_DAYS) -> DataFrame:
    """Calls and flagged calls in the windows that end at the newest call.

    One pass reduces to rows per day distance; the windows are sums over those.
    """
    newest_call = calls.agg(F.max("call_timestamp")).scalar()
    rows = (with_results(calls, pc, "left").withColumn("newest", newest_call)
            .withColumn("windows", F.array_compact(F.array(*[
                F.when(F.col("call_timestamp") >= F.col("newest")
                       - F.expr(f"INTERVAL '{d}' DAY"), F.lit(d)) for d in days]))))
    return (rows.select(F.explode("windows").alias("window_days"), "requires_enrichment")
            .groupBy("window_days").agg(
                F.count(F.lit(1)).alias("n_calls"),
                F.count_if(F.coalesce("requires_enrichment", F.lit(False))).alias("n_flagged"))
            .orderBy("window_days"))


# --- evaluation -------------------------------------------------------------
def truth_join(pc: DataFrame, truth: DataFrame) -> DataFrame:
    return pc.join(truth, "call_id")


def evaluate_importance(labelled: DataFrame, predicted: Column) -> DataFrame:
    hit = F.count_if(predicted & F.col("is_important"))
    return labelled.agg(
        F.count(F.lit(1)).alias("n"), hit.alias("true_positives"),
        F.try_divide(hit, F.count_if(predicted)).alias("precision"),
        F.try_divide(hit, F.count_if("is_important")).alias("recall"))


def evaluate_thresholds(labelled: DataFrame, score: str = "importance_score",
                        cost_per_call: float = 0.05, grid=K.THRESHOLD_GRID) -> DataFrame:
    """Precision, recall, flag rate and cost per threshold.

    Every call is first reduced to the number of thresholds it reaches.
    """
    reached = reduce(lambda a, b: a + b, [(F.col(score) >= F.lit(t)).cast("int") for t in grid])
    small = labelled.groupBy(reached.alias("reached"), "is_important").agg(
        F.count(F.lit(1)).alias("n"))
    flags = F.array(*[F.struct(F.lit(t).alias("threshold"),
                               (F.col("reached") > i).alias("flagged"))
                      for i, t in enumerate(grid)])
    flagged = F.when(F.col("f.flagged"), F.col("n")).otherwise(0)
    hit = F.when(F.col("f.flagged") & F.col("is_important"), F.col("n")).otherwise(0)
    relevant = F.when(F.col("is_important"), F.col("n")).otherwise(0)
    out = (small.withColumn("f", F.explode(flags)).groupBy("f.threshold").agg(
        F.try_divide(F.sum(hit), F.sum(flagged)).alias("precision"),
        F.try_divide(F.sum(hit), F.sum(relevant)).alias("recall"),
        F.try_divide(F.sum(flagged), F.sum("n")).alias("enrichment_rate")))
    return out.withColumn("cost_per_million", F.col("enrichment_rate")
                          * F.lit(cost_per_call) * F.lit(1000000.0)).orderBy("threshold")
