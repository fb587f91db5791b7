"""Quantiles and distinct users of an operation log, kept as mergeable sketches by the hour.

An hour's latencies are one KLL sketch and its users one HLL sketch per mode, so a day, a month or any
other span is merged from hours and the log isn't read again.  Sketches of up to `LATENCY_K` latencies are
exact; beyond that a quantile's rank is off by at most `rank_error()` with 99 % confidence.
Counts of users have a standard error of `user_error()`; within it, a figure may move with the order of merging.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.sources.stored import StoredTable

#: Size of a latency sketch: about 20 kB when full, ranks within 0.35 % of all rows.
LATENCY_K = 800
#: Binary logarithm of the slots of a user sketch: 16 kB when full, a standard error of 0.8 %.
USER_SLOTS = 14
HOURLY = ("hour timestamp_ntz, mode string, n long, n_errors long, n_cached long, n_deep long, "
          "cost decimal(30,9), latency binary, users binary")
QUANTILES = (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))


def rank_error(k: int = LATENCY_K) -> float:
    """Published bound on a KLL sketch's rank error, one-sided, at 99 % confidence."""
    return 2.296 / k ** 0.9723


def user_error(slots: int = USER_SLOTS) -> float:
    """Relative standard error of a merged HLL sketch."""
    return 1.04 / 2 ** (slots / 2)


def _sums() -> list[Column]:
    """Counts, cost and sketches of rows (mode, is_error, cache_hit, cost, latency_ms, user_id)."""
    return [F.count(F.lit(1)).alias("n"), F.count_if("is_error").alias("n_errors"),
            F.count_if("cache_hit").alias("n_cached"), F.count_if(F.col("mode") == "deep").alias("n_deep"),
            F.sum(F.col("cost").cast("decimal(20,9)")).alias("cost"),
            F.kll_sketch_agg_double(F.col("latency_ms").cast("double"), F.lit(LATENCY_K)).alias("latency"),
            F.hll_sketch_agg(F.col("user_id").cast("bigint"), F.lit(USER_SLOTS)).alias("users")]


def sketch_hours(log: DataFrame, ts: str = "ts") -> DataFrame:
    """One row per hour and mode; an hour holds as many rows as there are modes, whatever its traffic."""
    return log.groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour"), "mode").agg(*_sums()).select(
        "hour", "mode", "n", "n_errors", "n_cached", "n_deep", F.col("cost").cast("decimal(30,9)"), "latency", "users")


def merge(hours: DataFrame, *keys: str | Column) -> DataFrame:
    """Adds up sketched hours (or spans merged before) by any keys."""
    total = [F.sum(c).cast("bigint").alias(c) for c in ("n", "n_errors", "n_cached", "n_deep")]
    return hours.groupBy(*keys).agg(*total, F.sum("cost").cast("decimal(30,9)").alias("cost"),
                                    F.kll_merge_agg_double("latency", F.lit(LATENCY_K)).alias("latency"),
                                    F.hll_union_agg("users").alias("users"))


def quantile(sketch: Column, q: float) -> Column:
    """The least latency with at least a share `q` of all at or below it; NULL for no latencies."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(q)))


def figures(merged: DataFrame) -> DataFrame:
    """The sketches as numbers: quantiles, rates, cost and distinct users."""
    keys = [c for c in merged.columns if c not in ("n", "n_errors", "n_cached", "n_deep", "cost", "latency", "users")]
    return merged.select(
        *keys, "n", *[quantile(F.col("latency"), q).alias(name) for name, q in QUANTILES],
        (F.col("n_errors") / F.col("n")).alias("error_rate"), (F.col("n_cached") / F.col("n")).alias("cache_hit_rate"),
        (F.col("n_deep") / F.col("n")).alias("enrichment_rate"), F.col("cost").cast("double").alias("cost"),
        F.hll_sketch_estimate("users").alias("n_users"))


class OperationLog:
    """Sketched hours as a stored table: a batch of the log is added once, spans are answered from it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.table = StoredTable(spark, path, HOURLY)

    def add(self, log: DataFrame, batch: str, ts: str = "ts") -> None:
        self.table.append(sketch_hours(log, ts), batch)

    def compact(self, batch: str) -> None:
        """Merges the rows that several batches brought for the same hour."""
        if not self.table.has(batch):
            old = dict.fromkeys(self.table.parts())
            self.table.replace(merge(self.table.read(), "hour", "mode"), F.lit(batch), batch, [*old, batch])

    def spans(self, unit: str = "day", *keys: str, start: str | None = None, end: str | None = None) -> DataFrame:
        """Figures per span (hour, day, week, month, ...), for hours from `start` and before `end`."""
        rows = self.table.read()
        if start is not None:
            rows = rows.filter(F.col("hour") >= F.lit(start).cast("timestamp_ntz"))
        if end is not None:
            rows = rows.filter(F.col("hour") < F.lit(end).cast("timestamp_ntz"))
        return figures(merge(rows, F.date_trunc(unit, "hour").cast("timestamp_ntz").alias("span"), *keys))


def quantile_errors(answers: DataFrame, log: DataFrame, unit: str, ts: str = "ts") -> DataFrame:
    """By how much the rank of each answered quantile is off in the whole log, as a share of the span's rows.

    A value's ranks go from the share below it to the share at or below it; the error is the distance of
    the wanted share from that range.
    """
    span = F.date_trunc(unit, ts).cast("timestamp_ntz")
    rows = log.select(span.alias("span"), F.col("latency_ms").cast("double").alias("x"))
    asked = F.broadcast(answers.select("span", *[p for p, _ in QUANTILES]))      # one row per span
    below = [F.count_if(F.col("x") < F.col(p)).alias(f"{p}_lo") for p, _ in QUANTILES]
    upto = [F.count_if(F.col("x") <= F.col(p)).alias(f"{p}_hi") for p, _ in QUANTILES]
    counted = rows.join(asked, "span").groupBy("span").agg(F.count("x").alias("m"), *below, *upto)
    return counted.select("span", *[F.greatest(F.lit(0.0), F.col(f"{p}_lo") / F.col("m") - F.lit(q),
                                               F.lit(q) - F.col(f"{p}_hi") / F.col("m")).alias(f"{p}_error")
                                    for p, q in QUANTILES])


def stream_hours(log: DataFrame, ts: str = "ts", size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """The metrics that alerts watch, per window of a stream; the state of a window is its sums and sketches.

    Columns are those that `governance.alert_rules` reads.
    """
    return (log.withWatermark(ts, delay).groupBy(F.window(ts, size).alias("w")).agg(*_sums())
            .select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "n",
                    (F.col("n_errors") / F.col("n")).alias("error_rate"),
                    (quantile(F.col("latency"), 0.99) / F.lit(1000.0)).alias("p99_seconds"),
                    F.col("cost").cast("double").alias("cost"),
                    (F.col("n_cached") / F.col("n")).alias("cache_hit_rate"),
                    (F.col("n_deep") / F.col("n")).alias("enrichment_rate")))
