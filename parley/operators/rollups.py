"""Maintained roll-ups: counts of calls by day and category, kept up to date by changed calls.

Two stored tables: the facts, one narrow row per call in hash parts, say what a changed call
counted for before; the cube holds additive partials in one part per day.  A batch subtracts
the old rows of its calls, adds the new ones and rewrites the days that change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.operators import calls as C
from parley.plans.workspace import written
from parley.sources.stored import StoredTable, hashed_part

DIMENSIONS = ["day", "product", "region", "client_segment", "overall_intent", "overall_sentiment",
              "overall_importance", "requires_enrichment"]
FACT = ("call_id string, call_timestamp timestamp_ntz, day string, product string, region string, "
        "client_segment string, overall_intent string, overall_sentiment string, "
        "overall_importance string, requires_enrichment boolean, weighted_micros long")
CUBE = ("day string, product string, region string, client_segment string, overall_intent string, "
        "overall_sentiment string, overall_importance string, requires_enrichment boolean, n_calls long, "
        "n_scored long, weighted_micros long, first_call timestamp_ntz, last_call timestamp_ntz")
#: The day of calls without a time.
NO_DAY = "none"
DAY, MONTH = 10, 7


def call_facts(calls: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """One row per call, with its results where there are some."""
    rows = calls if results is None else calls.join(results.select(
        "call_id", "overall_intent", "overall_sentiment", "overall_importance", "requires_enrichment",
        "weighted_score"), "call_id", "left")
    for name, kind in (("overall_intent", "string"), ("overall_sentiment", "string"), ("overall_importance", "string"),
                       ("requires_enrichment", "boolean"), ("weighted_score", "double")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    ts = F.col("call_timestamp").cast("timestamp_ntz")
    return rows.select("call_id", ts.alias("call_timestamp"),
                       F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(NO_DAY)).alias("day"),
                       *DIMENSIONS[1:], C.micro(F.col("weighted_score")).alias("weighted_micros"))


class CallRollup:
    """The maintained cube in one folder.

    Its parts are the days that share the first `digits` characters: 10 for days, 7 for months.
    """

    def __init__(self, spark: SparkSession, path: str, digits: int = MONTH) -> None:
        self.facts = StoredTable(spark, f"{path}/facts", FACT)
        self.days = StoredTable(spark, f"{path}/days", CUBE)
        self.part = F.substring("day", 1, digits)

    def update(self, changed: DataFrame, batch: str) -> None:
        """Takes a batch of new or changed calls, as `call_facts` makes them.

        Of several rows of a call in a batch, that with the latest time counts.  Parts whose days lose or gain a call are
        rewritten, others aren't read.  Where a removed call was the first or last of
        its group, that group's ends are taken from the facts again.  The cube is committed
        before the facts, both under the name of the batch: after a failure between the two, a repeated
        batch finds the cube done and only brings the facts.
        """
        newest = [F.col("call_timestamp").desc_nulls_last(), *[F.col(c) for c in DIMENSIONS]]
        one = Window.partitionBy("call_id").orderBy(*newest)
        new = written(changed.select(*self.facts.schema.names).withColumn("r", F.row_number().over(one))
                      .filter("r = 1").drop("r"), "changed-calls")
        if not self.days.has(batch):
            self._count(new, batch)
        if not self.facts.has(batch):
            parts = self._parts(new)
            kept = self.facts.read(parts).join(new.select("call_id"), "call_id", "left_anti")
            self.facts.replace(kept.unionByName(new), hashed_part("call_id"), batch, parts)

    def _parts(self, rows: DataFrame) -> list[str]:
        return [r[0] for r in rows.select(hashed_part("call_id")).distinct().collect()]

    def _count(self, new: DataFrame, batch: str) -> None:
        old = self.facts.read(self._parts(new)).join(new.select("call_id"), "call_id", "left_semi")
        moved = written(new.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1))), "moved-calls")
        days = [r[0] for r in moved.select(self.part).distinct().collect()]       # the calendar's length at most
        sign, ts = F.col("sign"), F.col("call_timestamp")
        scored = F.col("weighted_micros").isNotNull()
        delta = moved.groupBy(*DIMENSIONS).agg(
            F.sum(sign).alias("n_calls"), F.sum(F.when(scored, sign).otherwise(0)).alias("n_scored"),
            F.sum(sign * F.coalesce("weighted_micros", F.lit(0))).alias("weighted_micros"),
            F.min(F.when(sign > 0, ts)).alias("first_call"), F.max(F.when(sign > 0, ts)).alias("last_call"),
            F.min(F.when(sign < 0, ts)).alias("gone_first"), F.max(F.when(sign < 0, ts)).alias("gone_last"))
        held = self.days.read(days).withColumn("gone_first", F.lit(None).cast("timestamp_ntz")) \
            .withColumn("gone_last", F.lit(None).cast("timestamp_ntz"))
        total = held.unionByName(delta).groupBy(*DIMENSIONS).agg(
            *[F.sum(c).alias(c) for c in ("n_calls", "n_scored", "weighted_micros")],
            F.min("first_call").alias("first_call"), F.max("last_call").alias("last_call"),
            F.min("gone_first").alias("gone_first"), F.max("gone_last").alias("gone_last")).filter("n_calls > 0")
        total = written(total, "cube")
        open_end = F.coalesce((F.col("gone_first") <= F.col("first_call"))
                              | (F.col("gone_last") >= F.col("last_call")), F.lit(False))
        stale = total.filter(open_end)
        names = self.days.schema.names
        out = total.filter(~open_end).select(*names)
        if not stale.isEmpty():
            now = self.facts.read().join(new.select("call_id"), "call_id", "left_anti").unionByName(new) \
                .filter(self.part.isin(days))
            same = [F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")) for c in DIMENSIONS]
            ends = stale.alias("s").join(now.alias("f"), same).groupBy(*[F.col(f"s.{c}") for c in names[:-2]]).agg(
                F.min("f.call_timestamp").alias("first_call"), F.max("f.call_timestamp").alias("last_call"))
            out = out.unionByName(ends)
        self.days.replace(out, self.part, batch, days)

    def cube(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """The partials, or those of the days from `start` to `end`; other days aren't read."""
        if start is None and end is None:
            return self.days.read()
        low, high = start or "", end or "9999-12-31"
        parts = [d for d in self.days.parts() if low[:len(d)] <= d <= high[:len(d)]]
        return self.days.read(parts).filter(F.col("day").between(low, high))


# --- answers from the cube --------------------------------------------------
def _counts(rows: DataFrame, by: Column, name: str) -> DataFrame:
    return rows.groupBy(by.alias(name)).agg(F.sum("n_calls").alias("n_calls"))


def summary_from(cube: DataFrame) -> DataFrame:
    """`calls.analytics_summary` without calls or turns."""
    return C.summary_of(cube.withColumnRenamed("n_calls", "n"))


def counts_from(cube: DataFrame, category: str) -> DataFrame:
    """`calls.count_by_category` without calls or turns."""
    table, column = C.CATEGORY_COLUMNS[category]
    rows = cube if table == "calls" else cube.filter(F.col("overall_importance").isNotNull())
    counts = _counts(rows, F.col(column), "category")
    total = F.sum("n_calls").over(Window.partitionBy())     # one row per category value
    return counts.withColumn("percentage", C.percentage(F.col("n_calls"), total)) \
        .orderBy(F.desc("n_calls"), "category")


def _period(period: str) -> Column:
    from parley.functions.text import period_trunc
    return period_trunc(F.to_timestamp_ntz("day", F.lit("yyyy-MM-dd")), period)


def volume_from(cube: DataFrame, period: str = "daily", n: int = 30) -> DataFrame:
    """`calls.call_volume_trend`; periods are days or longer."""
    rows = cube.withColumn("period", F.when(F.col("day") != NO_DAY, _period(period)))
    return C.latest_periods(rows.groupBy("period").agg(F.sum("n_calls").alias("call_count")), n)


def sentiment_from(cube: DataFrame, period: str = "daily", n: int = 30) -> DataFrame:
    """`calls.sentiment_trend`; periods are days or longer."""
    from parley import constants as K
    rows = cube.filter(F.col("overall_sentiment").isNotNull()) \
        .withColumn("period", F.when(F.col("day") != NO_DAY, _period(period)))
    counts = rows.groupBy("period").agg(*[F.coalesce(F.sum(F.when(
        F.col("overall_sentiment") == s, F.col("n_calls"))), F.lit(0)).alias(s) for s in K.SENTIMENTS])
    return C.latest_periods(counts, n)


def triage_from(cube: DataFrame) -> DataFrame:
    """`calls.triage_rate` without calls or turns."""
    rows, n = cube.filter(F.col("overall_importance").isNotNull()), F.sum("n_calls")
    some = lambda which: F.coalesce(F.sum(F.when(which, F.col("n_calls"))), F.lit(0))
    flagged, top = some(F.col("requires_enrichment")), some(F.col("overall_importance").isin("critical", "high"))
    return rows.agg(F.coalesce(n, F.lit(0)).alias("total_calls"), flagged.alias("flagged_calls"),
                    C.percentage(flagged, n).alias("flagged_pct"), top.alias("critical_high_calls"),
                    C.percentage(top, n).alias("critical_high_pct"))
