"""Question tables: classify, parse, answer from aggregates, reuse answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley import constants as K
from parley.plans.ordered import TURN_BLOCK, fold
from parley.plans.workspace import written
from parley.functions.triage import any_of
from parley.operators.calls import call_volume_trend, count_by_category, with_results


def _hits(text: Column, patterns) -> Column:
    total = F.lit(0)
    for p in patterns:
        total = total + text.rlike(p).cast("int")
    return total


def classify_queries(queries: DataFrame, text: str = "query_text") -> DataFrame:
    """Share of pattern hits per route; the best wins, low confidence is hybrid."""
    low = F.lower(text)
    out = (queries.withColumn("__a", _hits(low, K.ANALYTICS_RX))
           .withColumn("__s", _hits(low, K.SEARCH_RX))
           .withColumn("__i", _hits(low, K.INSIGHT_RX)))
    total = F.greatest(F.col("__a") + F.col("__s") + F.col("__i"), F.lit(1))
    conf = {"analytics": F.col("__a") / total, "search": F.col("__s") / total,
            "insight": F.col("__i") / total}
    best = F.greatest(*conf.values())
    intent = (F.when(conf["analytics"] == best, "analytics")
              .when(conf["search"] == best, "search").otherwise("insight"))
    sure = best >= F.lit(K.ROUTE_CONFIDENCE)
    kind = F.when(~sure, "hybrid").when(intent == "analytics", "aggregation").otherwise(intent)
    flag = lambda name: F.when(sure, intent == name).otherwise(
        conf[name] > F.lit(K.ROUTE_FLAG))
    return (out.withColumn("query_type", kind).withColumn("intent", intent)
            .withColumn("confidence", best)
            .withColumn("route_to_analytics", flag("analytics"))
            .withColumn("route_to_search", flag("search"))
            .withColumn("route_to_rag", flag("insight")).drop("__a", "__s", "__i"))


def extract_query_entities(queries: DataFrame, text: str = "query_text") -> DataFrame:
    """Products, intents, sentiments and timeframes named in the question."""
    low = F.lower(text)
    products = F.array_compact(F.array(*[F.when(any_of(low, words), F.lit(name))
                                         for name, words in K.QUESTION_PRODUCTS.items()]))
    intents = F.array_compact(F.array(
        F.when(any_of(low, K.QUESTION_COMPLAINT_WORDS), F.lit("complaint")),
        F.when(any_of(low, K.QUESTION_INQUIRY_WORDS), F.lit("inquiry"))))
    sentiments = F.array_compact(F.array(
        F.when(any_of(low, ("negative", "unhappy")), F.lit("negative"))
        .when(any_of(low, ("positive", "happy")), F.lit("positive"))))
    # the timeframe test and the extracted word may be different occurrences of "last"
    word = F.regexp_extract(low, r"\blast (\w+)\b", 1)
    timeframes = F.array_compact(F.array(F.when(low.rlike(K.TIMEFRAME_RX), word)))
    return (queries.withColumn("products", products).withColumn("intents", intents)
            .withColumn("sentiments", sentiments).withColumn("timeframes", timeframes))


def parse_analytics_question(queries: DataFrame, text: str = "query_text") -> DataFrame:
    """Question kind with product, intent and sentiment; NULL kind if not analytic."""
    low = F.lower(text)
    kind = F.lit(None).cast("string")
    for name, words in reversed(K.QUESTION_KINDS):
        kind = F.when(any_of(low, words), name).otherwise(kind)
    product = F.lit(None).cast("string")
    for word, name in K.ASKED_PRODUCTS:
        product = F.when(low.contains(word), name).otherwise(product)
    intent = F.lit(None).cast("string")
    for name, words in reversed(K.ASKED_INTENTS):
        intent = F.when(any_of(low, words), name).otherwise(intent)
    sentiment = F.when(low.contains("negative"), "negative").when(
        low.contains("positive"), "positive")
    known = kind.isNotNull()
    return (queries.withColumn("kind", kind).withColumn("product", F.when(known, product))
            .withColumn("asked_intent", F.when(known, intent))
            .withColumn("asked_sentiment", F.when(known, sentiment)))


def answer_analytics_questions(queries: DataFrame, calls: DataFrame, pc: DataFrame,
                               query_id: str = "query_id",
                               text: str = "query_text") -> DataFrame:
    """(query, kind, label, value): counts, breakdowns and daily trends.

    The calls are aggregated once (a cube by product, intent and sentiment; three
    breakdowns; 30 days) and every question meets those by equality.
    Questions are reduced to their distinct parses first.
    """
    parsed = parse_analytics_question(queries.select(query_id, text), text).filter(
        F.col("kind").isNotNull())
    slots = ["kind", "product", "asked_intent", "asked_sentiment"]
    asked = parsed.select(*slots).distinct()
    seen = {"product": "product", "asked_intent": "overall_intent",
            "asked_sentiment": "overall_sentiment"}
    base = with_results(calls, pc, "left").groupBy(
        *[F.col(c).alias(f"c_{s}") for s, c in seen.items()]).agg(F.count(F.lit(1)).alias("n"))
    # a slot that was not asked for is met by the rolled-up rows, whose value is null too
    cube = base.cube(*[f"c_{s}" for s in seen]).agg(
        F.sum("n").alias("n"), *[F.grouping(f"c_{s}").alias(f"all_{s}") for s in seen])
    for s in seen:
        cube = cube.filter((F.col(f"all_{s}") == 1) | F.col(f"c_{s}").isNotNull())
    counts = (asked.filter("kind = 'count'")
              .join(cube, [F.col(s).eqNullSafe(F.col(f"c_{s}")) for s in seen], "left")
              .select(*slots, F.lit("count").alias("label"),
                      F.coalesce("n", F.lit(0)).cast("bigint").alias("value")))
    breakdown = lambda c: count_by_category(calls, pc, c).select(
        F.lit(c).alias("by"), F.col("category").alias("label"), F.col("n_calls").alias("value"))
    shares = (asked.filter("kind IN ('percentage', 'top')")
              .withColumn("by", F.when(F.col("asked_intent").isNotNull(), "intent")
                          .otherwise("product"))
              .join(breakdown("intent").unionByName(breakdown("product")), "by").drop("by"))
    trend = call_volume_trend(calls, "daily", 30).select(
        F.lit("trend").alias("kind"), F.date_format("period", "yyyy-MM-dd").alias("label"),
        F.col("call_count").alias("value"))
    trends = asked.filter("kind = 'trend'").join(trend, "kind")
    answers = counts.unionByName(shares).unionByName(trends)
    same = [F.col(f"q.{s}").eqNullSafe(F.col(f"a.{s}")) for s in slots]
    return (parsed.alias("q").join(answers.alias("a"), same)
            .select(F.col(f"q.{query_id}").alias(query_id), "q.kind", "a.label", "a.value"))


def with_route(classified: DataFrame) -> DataFrame:
    """Route taken and its fixed cost; insight and hybrid go to retrieval."""
    route = (F.when(F.col("query_type") == "aggregation", "analytics")
             .when(F.col("query_type") == "search", "search").otherwise("rag"))
    return classified.withColumn("route", route)


def route_stats(classified: DataFrame, answers: DataFrame) -> DataFrame:
    """Questions and cost per route; retrieval cost comes from the answer table."""
    fixed = (F.when(F.col("route") == "analytics", F.lit(K.ANALYTICS_COST))
             .when(F.col("route") == "search", F.lit(K.SEARCH_COST)))
    priced = (with_route(classified).join(
        answers.select("query_text", F.col("cost_usd").alias("__cost")), "query_text", "left")
        .withColumn("cost", F.coalesce(fixed, "__cost", F.lit(0.0))))
    from parley.operators.calls import exact_sum
    return priced.groupBy("route").agg(F.count(F.lit(1)).alias("n_queries"),
                                       exact_sum("cost", 12).alias("total_cost"))


def dedupe_queries(log: DataFrame, ttl: int = K.CACHE_TTL_SECONDS, text: str = "query_text",
                   ts: str = "ts", filters: tuple[str, ...] = ()) -> DataFrame:
    """Flag questions answered by a result stored at most `ttl` seconds before.

    The key is the question and the values of `filters`.  A miss stores its result;
    a hit does not renew it, so whether a question is a hit depends on the last
    miss: a fold with one number as state, run by key and block of time.
    Questions asked at the same instant are one step; the smallest query_id leads.
    """
    width = ttl * 1_000_000
    asked = F.lower(F.trim(text))
    if filters:
        asked = F.concat_ws("\n", asked, F.to_json(F.struct(*filters)))
    rows = (log.withColumn("query_key", F.sha2(asked, 256))
            .withColumn("__at", F.unix_micros(F.col(ts).cast("timestamp"))))
    instants = written(rows.groupBy("query_key", "__at").agg(F.min("query_id").alias("__leader")),
                       "instants")

    def step(stored, at):
        if stored is not None and at - stored <= width:
            return stored, True
        return int(at), False

    flagged = fold(instants, ["query_key"], "__at", ["__at"], step, None, "__hit",
                   size=TURN_BLOCK * width)
    return (rows.join(flagged, ["query_key", "__at"])
            .withColumn("cache_hit", F.col("__hit") | (F.col("query_id") != F.col("__leader")))
            .drop("__at", "__leader", "__hit"))


def cache_hit_rate(deduped: DataFrame) -> DataFrame:
    return deduped.agg(F.count(F.lit(1)).alias("n_queries"),
                       F.count_if("cache_hit").alias("n_hits"),
                       F.try_divide(F.count_if("cache_hit"), F.count(F.lit(1)))
                       .alias("hit_rate"))


def query_volume_by_type(classified: DataFrame) -> DataFrame:
    return classified.groupBy("query_type").agg(F.count(F.lit(1)).alias("n_queries"))


def daily_users(log: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct users per day; first reduced to one row per day and user."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    if approximate:
        return log.groupBy(day).agg(F.approx_count_distinct("user_id").alias("n_users"))
    return (log.select(day, "user_id").distinct().groupBy("day")
            .agg(F.count(F.lit(1)).alias("n_users")))


