"""Personal data, audit, alerts, feedback, languages and operation metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley import constants as K
from parley.functions import pii
from parley.functions import vectors as V


# --- personal data ----------------------------------------------------------
def detect_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """Kinds found and number of spans per kind."""
    t = F.col(text)
    out = df.withColumn("pii_types", pii.pii_types(t))
    counts = {kind: pii.pii_count(t, kind) for kind in K.PII_RX}
    for kind, n in counts.items():
        out = out.withColumn(f"n_{kind}", n)
    return out.withColumn("n_pii", reduce(lambda a, b: a + b,
                                          [F.col(f"n_{kind}") for kind in counts]))


def redact_pii(df: DataFrame, text: str = "text", out: str = "redacted") -> DataFrame:
    return df.withColumn(out, pii.redact(F.col(text)))


def pii_report(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Rows and keys with each kind of personal data, and the share of rows."""
    n = df.agg(F.count(F.lit(1))).scalar()
    found = df.select(key, F.explode(pii.pii_types(F.col(text))).alias("pii_type"))
    per_key = found.groupBy("pii_type", key).agg(F.count(F.lit(1)).alias("n"))
    return (per_key.groupBy("pii_type").agg(F.sum("n").alias("n_rows"),
                                            F.count(F.lit(1)).alias("n_keys"))
            .withColumn("row_share", F.col("n_rows") / n))


# --- audit, metrics ---------------------------------------------------------
def audit_log_rollup(audit: DataFrame) -> DataFrame:
    """Accesses per user, action and resource.

    `audit` has (user_id, action, resource_type, calls_accessed).
    """
    return (audit.select("user_id", "action", "resource_type",
                         F.explode("calls_accessed").alias("resource_id"))
            .groupBy("user_id", "action", "resource_type", "resource_id")
            .agg(F.count(F.lit(1)).alias("n_accesses")))


def metric_key(name: Column, labels: Column) -> Column:
    """`name{k=v,...}` with sorted labels; the bare name without labels."""
    pairs = F.transform(F.array_sort(F.map_entries(labels)),
                        lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.when(F.coalesce(F.size(labels), F.lit(0)) <= 0, name).otherwise(
        F.concat(name, F.lit("{"), F.array_join(pairs, ","), F.lit("}")))


def metric_counters(events: DataFrame) -> DataFrame:
    """Sum of increments per metric key; gauges keep the latest value.

    `events` has (metric, labels, value, ts, event_id).
    """
    return (events.withColumn("metric_key", metric_key(F.col("metric"), F.col("labels")))
            .groupBy("metric_key").agg(
                F.sum(F.col("value").cast("decimal(30,6)")).cast("double").alias("counter"),
                F.max_by("value", F.struct("ts", "event_id")).alias("gauge")))


def quality_metrics(answers: DataFrame, pc: DataFrame) -> DataFrame:
    """Mean answer confidence, share with citations, enrichment rate."""
    n = F.count(F.lit(1))
    rate = pc.agg(F.try_divide(F.count_if("requires_enrichment"), F.count(F.lit(1)))).scalar()
    return answers.agg(F.avg("confidence").alias("avg_confidence"),
                       F.try_divide(F.count_if(F.col("citations") != ""), n)
                       .alias("citation_rate")).withColumn("enrichment_rate", rate)


def daily_burn(ledger: DataFrame, ts: str = "ts", cost: str = "cost") -> DataFrame:
    from parley.operators.calls import exact_sum
    return ledger.groupBy(F.date_trunc("day", ts).cast("timestamp_ntz").alias("day")).agg(
        exact_sum(cost, 12).alias("cost_usd"))


def latency_percentiles(log: DataFrame, keys=("mode",), latency: str = "latency_ms",
                        accuracy: int = 10000) -> DataFrame:
    """p50/p95/p99 and error rate per key, from mergeable sketches."""
    p = F.percentile_approx(latency, [0.5, 0.95, 0.99], accuracy)
    return log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), p.alias("p"),
        (F.count_if("is_error") / F.count(F.lit(1))).alias("error_rate")).select(
        *keys, "n", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"),
        F.col("p")[2].alias("p99"), "error_rate")


def hourly_metrics(log: DataFrame, ts: str = "ts", latency: str = "latency_ms") -> DataFrame:
    """Error rate, p99 latency, cost and cache hits per hour of an operation log.

    `log` has (ts, is_error, latency, cost, cache_hit).
    """
    from parley.operators.calls import exact_sum
    n = F.count(F.lit(1))
    return log.groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")).agg(
        (F.count_if("is_error") / n).alias("error_rate"),
        (F.percentile_approx(latency, 0.99, 10000) / F.lit(1000.0)).alias("p99_seconds"),
        exact_sum("cost", 9).alias("cost"), (F.count_if("cache_hit") / n).alias("cache_hit_rate"))


def alert_rules(hourly: DataFrame) -> DataFrame:
    """Alerts that fire per hour.

    `hourly` has (hour, error_rate, p99_seconds, cost, cache_hit_rate,
    enrichment_rate); a NULL metric fires nothing.
    """
    rules = {
        "HighErrorRate": F.col("error_rate") > F.lit(K.ALERT_ERROR_RATE),
        "HighLatency": F.col("p99_seconds") > F.lit(K.ALERT_P99_SECONDS),
        "CostSpike": F.col("cost") > F.lit(K.ALERT_HOURLY_COST),
        "LowCacheHitRate": F.col("cache_hit_rate") < F.lit(K.ALERT_CACHE_HITS),
        "HighEnrichmentRate": F.col("enrichment_rate") > F.lit(K.ALERT_ENRICHMENT_RATE),
    }
    fired = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))
    return hourly.select("hour", F.explode(fired).alias("alert"))


def feedback_metrics(feedback: DataFrame) -> DataFrame:
    """`feedback` has (helpful, rating)."""
    share = F.try_divide(F.count_if("helpful"), F.count(F.lit(1)))
    rating = F.sum(F.col("rating").cast("bigint")) / F.count("rating")
    return feedback.agg(
        F.count(F.lit(1)).alias("n"), share.alias("helpful_share"), rating.alias("avg_rating"),
        (share > F.lit(K.FEEDBACK_THUMBS)).alias("meets_thumbs"),
        (rating > F.lit(K.FEEDBACK_RATING)).alias("meets_rating"))


# --- languages --------------------------------------------------------------
# Frequent function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": ("the", "and", "of", "to", "in", "that", "it", "was", "for", "with"),
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "mit", "auf", "zu"),
    "fr": ("le", "la", "les", "des", "une", "est", "que", "dans", "qui", "pas"),
    "es": ("el", "los", "las", "una", "por", "con", "para", "del", "como", "su"),
}


def detect_language(text: Column) -> Column:
    """The language with most function words; ties and no hits go to the first."""
    def best(tokens):
        hits = [F.size(F.filter(tokens, lambda t: t.isin(*words)))
                for words in FUNCTION_WORDS.values()]
        most = F.array(*hits)
        return F.array_position(most, F.array_max(most))
    place = V.once(V.tokens(text), best).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in FUNCTION_WORDS]), place)


def language_split(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("detected", detect_language(F.col(text)))


def language_report(split: DataFrame, truth: str = "lang") -> DataFrame:
    return split.groupBy("detected").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.col(truth) == F.col("detected")).alias("n_right"))
