"""Streams of transcripts, turns and operation events.

Every function takes a streaming DataFrame (from files, Kafka, ...) and returns
one; `run_to_table` drains a stream into a Parquet table for bounded runs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from parley import constants as K
from parley.operators.calls import analyze_segments, roll_up_numbers, turn_numbers
from parley.functions import triage as T
from parley.plans.workspace import new_path
from parley.sources.stored import StoredTable, hashed_part
from parley.sources.transcripts import SCHEMA, call_metadata, explode_turns, reject_reason, split_valid


# --- sources and sinks ------------------------------------------------------
def read_transcripts(spark: SparkSession, path: str, files_per_trigger: int = 1000,
                     one_per_file: bool = True) -> DataFrame:
    """New transcript files as they arrive."""
    return (spark.readStream.schema(SCHEMA).option("multiLine", one_per_file)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("maxFilesPerTrigger", files_per_trigger).json(path))


def read_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Transcript documents from a topic (needs Spark's Kafka package)."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).load())
    return raw.select(F.from_json(F.col("value").cast("string"), SCHEMA).alias("d")).select("d.*")


def read_table(spark: SparkSession, path: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def run_to_table(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Process everything that is available and return the written rows."""
    spark = stream.sparkSession
    out, state = new_path(spark, label), new_path(spark, label + "-state")
    query = (stream.writeStream.outputMode(mode).format("parquet").option("path", out)
             .option("checkpointLocation", state).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_latest(stream: DataFrame, label: str, keys) -> DataFrame:
    """Drain an updating aggregate; the newest row per key is the result.

    Each micro-batch writes its changed rows to its own folder, so a replayed
    batch overwrites itself.
    """
    spark = stream.sparkSession
    out, state = new_path(spark, label), new_path(spark, label + "-state")

    def upsert(rows, batch):
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query = (stream.writeStream.outputMode("update").foreachBatch(upsert)
             .option("checkpointLocation", state).trigger(availableNow=True).start())
    query.awaitTermination()
    schema = ST.StructType([*stream.schema.fields, ST.StructField("batch", ST.LongType())])
    written = spark.read.schema(schema).parquet(out)
    w = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return (written.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") == 1)
            .drop("__r", "batch"))


# --- operators --------------------------------------------------------------
def stream_ingest(documents: DataFrame) -> DataFrame:
    """Valid documents to turn rows; bad ones are left out, never fatal."""
    return explode_turns(split_valid(documents)[0])


CALL_KEYS, TURN_KEYS = ["call_id"], ["call_id", "turn_index"]
REJECT = "call_id string, reason string, document string, delivered long"


class IngestTables:
    """The stored turns, calls and rejects that a stream of documents keeps up to date."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        empty = spark.createDataFrame([], SCHEMA)
        stamp = lambda df: df.withColumn("ingested", F.lit("")).withColumn("delivered", F.lit(0).cast("long"))
        self.turns = StoredTable(spark, f"{path}/turns", stamp(explode_turns(empty)).schema)
        self.calls = StoredTable(spark, f"{path}/calls", stamp(call_metadata(empty)).schema)
        self.rejects = StoredTable(spark, f"{path}/rejects", REJECT)

    def take(self, documents: DataFrame, batch: int, name: str = "ingest") -> None:
        """One batch of documents: later ones, by ingestion time, then batch, replace calls and turns.

        Each table commits the batch under its number, so a batch that is delivered again, or one that died
        half way and is repeated, changes only the tables that lack it.  Rejects are kept with a reason.
        """
        documents = documents.persist()
        ok, bad = split_valid(documents)
        at = F.coalesce("ingestion_timestamp", F.lit(""))
        number, order = F.lit(batch).cast("long"), [F.desc("ingested"), F.desc("delivered")]
        turns = explode_turns(ok.select("call_id", "first_turn", "transcript", "ingestion_timestamp"), [at.alias("ingested")])
        calls = call_metadata(ok).withColumn("ingested", F.coalesce(F.date_format(
            "ingestion_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("")))
        self.rejects.append(bad.select("call_id", reject_reason().alias("reason"), F.to_json(F.struct(
            *[c for c in bad.columns])).alias("document"), number.alias("delivered")), f"{name}-{batch}")
        self.turns.upsert(turns.withColumn("delivered", number), TURN_KEYS,
                          [*order, "start_time", "speaker", "text"], f"{name}-{batch}")
        self.calls.upsert(calls.withColumn("delivered", number), CALL_KEYS,
                          [*order, "call_timestamp", "client_id", "agent_id", "product"], f"{name}-{batch}")
        documents.unpersist()


def stream_to_tables(documents: DataFrame, path: str, name: str = "ingest") -> IngestTables:
    """Drains a stream of documents into stored tables; it can be stopped and started again."""
    tables = IngestTables(documents.sparkSession, path)
    query = (documents.writeStream.foreachBatch(lambda rows, n: tables.take(rows, n, name))
             .option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    return tables


def stream_triage(turns: DataFrame) -> DataFrame:
    """Score each turn as it arrives and keep the critical ones as alerts."""
    return analyze_segments(turns).filter("is_critical").select(
        "segment_id", "call_id", "intent", "sentiment", "importance_score")


def stream_dedupe(turns: DataFrame, ts: str = "event_time", delay: str = "10 minutes",
                  keys=("call_id", "turn_index")) -> DataFrame:
    """Drop re-delivered turns that arrive within the watermark."""
    return turns.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_call_rollup(turns: DataFrame, ts: str = "event_time", gap: str = "5 minutes",
                       delay: str = "10 minutes") -> DataFrame:
    """Roll up a call once it has been silent for `gap`.

    Scores are summed in whole units, so the state is a handful of integers per
    open call and the order of arrival does not matter.
    """
    return stream_calls(turns, ts, gap, delay).select(
        "call_id", F.col("total_segments").cast("long").alias("total_segments"),
        F.col("high_priority_segments").cast("long").alias("high_priority_segments"), "overall_intent",
        "weighted_score", "overall_importance", "requires_enrichment")


def stream_calls(turns: DataFrame, ts: str = "event_time", gap: str = "5 minutes",
                 delay: str = "10 minutes") -> DataFrame:
    """Every column of the batch roll-up for each call that has been silent for `gap`."""
    numbers = at_each_time(turn_numbers(analyze_segments_with(turns, ts), ts), ts).withWatermark(ts, delay)
    return roll_up_numbers(numbers, F.session_window(ts, gap).alias("w"))


def late_turns(received: DataFrame, rolled: DataFrame, ts: str = "event_time") -> DataFrame:
    """Turns that were received but came too late for the roll-up of their call, which is closed.

    Compares the turns as they were ingested with the numbers that the stream rolled up; calls that
    are still open have no row, closed ones without late turns 0.
    """
    times = F.size(ts) if ts in received.columns and _listed(received, ts) else F.lit(1)
    got = received.groupBy("call_id").agg(F.sum(times.cast("long")).alias("n_received"))
    closed = rolled.groupBy("call_id").agg(F.sum("total_segments").alias("n_rolled"))
    return closed.join(got, "call_id").select(
        "call_id", "n_received", "n_rolled", (F.col("n_received") - F.col("n_rolled")).alias("n_late"))


def _listed(turns: DataFrame, ts: str) -> bool:
    """Whether `ts` lists the times of a turn: an id that several calls share has the turn at the time of each."""
    return isinstance(turns.schema[ts].dataType, ST.ArrayType)


def at_each_time(turns: DataFrame, ts: str) -> DataFrame:
    """Turns, scored once, at each of their times."""
    return turns.withColumn(ts, F.explode(ts)) if _listed(turns, ts) else turns


#: Times of turns that a task counts at once.
COUNTED_TIMES = 1 << 20


def counted_times(scored: DataFrame, ts: str) -> DataFrame:
    """(call_id, ts, n, critical): turns of a call at one time, counted where they are if `ts` lists their times."""
    critical = F.coalesce(F.col("is_critical").cast("long"), F.lit(0)).alias("critical")
    if not _listed(scored, ts):
        return scored.select("call_id", F.col(ts), F.lit(1).cast("long").alias("n"), critical)

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            place = np.cumsum(np.diff(batch.column(1).offsets.to_numpy())) // COUNTED_TIMES
            edges = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)]
            for a, b in zip(edges, edges[1:]):
                calls, times = batch.column(0).slice(a, b - a).dictionary_encode(), batch.column(1).slice(a, b - a)
                turn = times.value_parent_indices()
                found = pa.table({"call": calls.indices.take(turn), "at": times.flatten().cast("int64"),
                                  "critical": batch.column(2).slice(a, b - a).take(turn)}).group_by(
                    ["call", "at"], use_threads=False).aggregate([([], "count_all"), ("critical", "sum")]).combine_chunks()
                for part in found.to_batches():
                    yield pa.RecordBatch.from_arrays([
                        calls.dictionary.take(part.column("call")), part.column("at"), part.column("count_all"),
                        part.column("critical_sum")], names=["call_id", "at", "n", "critical"])

    counted = scored.select("call_id", F.col(ts), critical).mapInArrow(
        count, "call_id string, at long, n long, critical long")
    return counted.select("call_id", F.timestamp_micros("at").alias(ts), "n", "critical")


def analyze_segments_with(turns: DataFrame, *extra: str) -> DataFrame:
    """Turn scoring that carries further columns along."""
    text = F.col("text")
    out = (turns.withColumn("intent", T.classify_intent(text))
           .withColumn("sentiment", T.analyze_sentiment(text))
           .withColumn("importance_score", T.importance_score(
               F.col("intent"), F.col("sentiment"), T.number_found(F.lower(text), K.HIGH_KEYWORDS),
               T.number_found(F.lower(text), K.MEDIUM_KEYWORDS),
               T.is_customer(F.col("speaker")))))
    return out.withColumn("is_critical", T.is_critical(F.col("importance_score"))).select(
        "call_id", "turn_index", "speaker", "intent", "sentiment", "importance_score",
        "is_critical", *extra)


def stream_volume(events: DataFrame, ts: str = "ts", size: str = "1 hour", slide: str | None = None,
                  delay: str = "10 minutes", **sums) -> DataFrame:
    """Counts, error rate and cost per tumbling (or sliding) window."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (events.withWatermark(ts, delay).groupBy(window.alias("w")).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if("is_error").alias("n_errors"),
        F.sum(F.col("cost").cast("decimal(20,6)")).cast("double").alias("cost"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "n_events", "n_errors",
                (F.col("n_errors") / F.col("n_events")).alias("error_rate"), "cost"))


def volume_alerts(windows: DataFrame) -> DataFrame:
    """The error-rate and cost alerts on windowed counts."""
    rules = F.array_compact(F.array(
        F.when(F.col("error_rate") > F.lit(K.ALERT_ERROR_RATE), F.lit("HighErrorRate")),
        F.when(F.col("cost") > F.lit(K.ALERT_HOURLY_COST), F.lit("CostSpike"))))
    return windows.select("window_start", F.explode(rules).alias("alert"))


#: Groups that the open calls are dealt to where Python keeps their state: a group costs milliseconds, a call in it little.
CALL_GROUPS = 8192


def by_call_groups(rows: DataFrame) -> DataFrame:
    """Rows with `calls_of`, the group that their call's state is kept in."""
    return rows.withColumn("calls_of", F.pmod(F.xxhash64("call_id"), F.lit(CALL_GROUPS)).cast("int"))


PROGRESS_SCHEMA = ("call_id string, part int, n_turns bigint, n_critical bigint, "
                   "is_final boolean")


def progressive_summary(turns: DataFrame, ts: str = "event_time", every: str = "10 minutes",
                        delay: str = "10 minutes") -> DataFrame:
    """Partial result of each live call per `every`, as its window closes."""
    scored = analyze_segments_with(turns, ts).select("call_id", ts, "is_critical", "importance_score")
    return (at_each_time(scored, ts).withWatermark(ts, delay)
            .groupBy("call_id", F.window(ts, every).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_turns"),
                 F.count_if("is_critical").alias("n_critical"),
                 F.max("importance_score").alias("max_importance"))
            .select("call_id", F.col("w.start").alias("window_start"), "n_turns", "n_critical",
                    "max_importance"))


def progressive_summary_final(turns: DataFrame, ts: str = "event_time",
                              delay: str = "10 minutes", gap_seconds: int = 300) -> DataFrame:
    """Counts of a live call after every micro-batch and once more when it ends.

    The state of a call is four numbers, kept with those of its group's other calls; a timer set from
    the watermark emits the final row after `gap_seconds` without turns.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    gap, names = gap_seconds * 1000, [c.split()[0] for c in PROGRESS_SCHEMA.split(", ")]
    scored = by_call_groups(counted_times(analyze_segments_with(turns, ts), ts).withWatermark(ts, delay).select(
        "call_id", F.col(ts), "n", "critical", F.coalesce(F.unix_millis(ts), F.lit(0)).alias("at")))

    def advance(key, batches: Iterator, state: GroupState):
        import pandas as pd
        open_calls = {c: v for c, *v in zip(*state.get)} if state.exists else {}
        mark, heard, rows = state.getCurrentWatermarkMs(), set(), []
        for pdf in () if state.hasTimedOut else batches:
            for call, n, critical, at in zip(*(pdf[c].tolist() for c in ("call_id", "n", "critical", "at"))):
                v = open_calls.setdefault(call, [0, 0, 0, 0])
                v[1], v[2], v[3] = v[1] + n, v[2] + critical, max(v[3], at)
                heard.add(call)
        for call in heard:
            v = open_calls[call]
            v[0] += 1
            rows.append((call, *v[:3], False))
        for call in [c for c, v in open_calls.items() if c not in heard and v[3] + gap < mark]:
            part, n, critical, _ = open_calls.pop(call)
            rows.append((call, part + 1, n, critical, True))
        if open_calls:
            state.update((list(open_calls), *map(list, zip(*open_calls.values()))))
            # can't be set at the watermark
            state.setTimeoutTimestamp(max(min(v[3] for v in open_calls.values()) + gap, mark + 1))
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=names)

    return scored.groupBy("calls_of").applyInPandasWithState(
        advance, PROGRESS_SCHEMA, "call array<string>, part array<int>, n array<bigint>, critical array<bigint>, "
        "last array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)


LIVE = ("call_id string, started timestamp, part long, until timestamp, n_turns long, n_critical long, "
        "is_final boolean")
LIVE_STATE = ("call array<string>, started array<long>, last array<long>, n array<long>, critical array<long>, "
              "part array<long>, later array<array<long>>")


def advance_call(state: tuple, fresh: list[int] | dict[int, int], mark: int, every: int, gap: int) -> tuple[tuple, list[tuple]]:
    """Moves one call on to the watermark; times are whole microseconds.

    `state` is (started, last, n, critical, part, later): the sums of the open session's turns up to
    the watermark, and later turns as 2 * time + critical, each followed by how many such turns there are.
    `fresh` lists such numbers, or says how many there are of each.  Returns the new state and rows (started,
    part, until, n, critical, is_final) for every boundary and end that lies before the watermark.
    """
    started, last, n, critical, part, later = state
    rows, waiting = [], Counter(dict(zip(later[::2], later[1::2])))
    waiting.update(fresh)

    def close(limit):
        nonlocal n, critical, part
        end = last + gap
        while n and (edge := started + (part + 1) * every) < end and edge < limit:
            part += 1
            rows.append((started, part, edge, n, critical, False))
        if n and end < limit:
            rows.append((started, part + 1, end, n, critical, True))
            n = critical = part = 0

    for code in sorted(waiting):
        at, is_critical = divmod(code, 2)
        if at > mark:
            break
        close(at + 1)                       # a turn at an edge or an end belongs behind it
        started = started if n else at
        number = waiting.pop(code)
        last, n, critical = at, n + number, critical + is_critical * number
    close(mark)
    return (started, last, n, critical, part, [x for code in sorted(waiting) for x in (code, waiting[code])]), rows


def live_summaries(turns: DataFrame, ts: str = "event_time", every_seconds: int = 600, gap_seconds: int = 300,
                   delay: str = "10 minutes") -> DataFrame:
    """Counts of a live call at every ten minutes of its own time, then once more when it ends.

    A session begins with a turn and ends `gap_seconds` behind its last one.  A row is emitted when the
    watermark passes its `until`, and holds the turns before that, so the rows depend on the turns alone,
    not on how they fell into micro-batches.  The state of a call is five numbers and its turns since
    the watermark, counted by time and kept with those of its group's other calls; turns that the watermark refuses are left
    out, turns without a time too.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    every, gap = every_seconds * 1_000_000, gap_seconds * 1_000_000
    names = [c.split()[0] for c in LIVE.split(", ")]
    scored = by_call_groups(counted_times(analyze_segments_with(turns, ts), ts).withWatermark(ts, delay).filter(
        F.col(ts).isNotNull()).select("call_id", F.col(ts), "n", "critical", (F.unix_micros(ts) * 2).alias("code")))

    def step(key, batches: Iterator, state: GroupState):
        import pandas as pd
        old = {c: v for c, *v in zip(*state.get)} if state.exists else {}
        mark, fresh, kept, rows, timers = state.getCurrentWatermarkMs(), {}, {}, [], []
        for pdf in () if state.hasTimedOut else batches:
            for call, code, n, critical in zip(*(pdf[c].tolist() for c in ("call_id", "code", "n", "critical"))):
                own = fresh.setdefault(call, Counter())
                own.update({c: k for c, k in ((code, n - critical), (code + 1, critical)) if k})
        for call in old | fresh:
            *sums, later = old.get(call, (0, 0, 0, 0, 0, []))
            new, due = advance_call((*sums, list(later)), fresh.get(call, []), mark * 1000, every, gap)
            rows += [(call, *r) for r in due]
            started, last, n, _, part, later = new
            if n or later:
                kept[call] = new
                timers.append((min(started + (part + 1) * every, last + gap) if n else later[0] // 2) // 1000)
        if kept:
            state.update((list(kept), *map(list, zip(*kept.values()))))
            # a timer fires behind its millisecond, and can't be set at the watermark
            state.setTimeoutTimestamp(max(min(timers), mark + 1))
        elif state.exists:
            state.remove()
        if not rows:
            return
        out = pd.DataFrame(rows, columns=names)
        for c in ("started", "until"):
            out[c] = pd.to_datetime(out[c].astype("int64"), unit="us", utc=True)
        yield out

    return scored.groupBy("calls_of").applyInPandasWithState(
        step, LIVE, LIVE_STATE, "append", GroupStateTimeout.EventTimeTimeout)


# --- spikes ------------------------------------
def volume_spikes(rows: DataFrame, ts: str, label: str, sigmas: float = 2.0, back: int = 7,
                  unit: str = "day") -> DataFrame:
    """Periods whose count exceeds the trailing mean by `sigmas` deviations,
    with the most frequent label of the period (ties: first by name).

    Rows are first reduced to one per period and label.  The windows then run
    over periods, so their size is the length of the calendar, not the data.
    """
    period = F.date_trunc(unit, ts).cast("timestamp_ntz").alias("period")
    per_label = rows.groupBy(period, F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"))
    counts = per_label.groupBy("period").agg(
        F.sum("n").alias("n_rows"),
        F.min(F.struct(-F.col("n"), "label"))["label"].alias("dominant"))
    w = Window.partitionBy().orderBy("period").rowsBetween(-back, -1)
    n = F.count("n_rows").over(w)
    mean = F.sum("n_rows").over(w) / n
    square = F.sum(F.col("n_rows") * F.col("n_rows")).over(w) / n
    spread = F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))
    scored = counts.select("period", "n_rows", n.alias("n_before"), mean.alias("mean"),
                           spread.alias("spread"), "dominant")
    return (scored.filter((F.col("n_before") >= back)
                          & (F.col("n_rows") > F.col("mean") + F.lit(sigmas) * F.col("spread")))
            .select("period", "n_rows", F.round("mean", 6).alias("mean"),
                                          F.round("spread", 6).alias("spread"), "dominant"))


def _period_counts(rows: DataFrame, period: Column, label: str, series: str, hours: int) -> DataFrame:
    """(series, no, label, n): rows per series, numbered period of `hours` and label."""
    text = lambda c, name: F.col(c).cast("string").alias(name)
    return (rows.groupBy(text(series, "series"), period.alias("w"), text(label, "label")).agg(F.count(F.lit(1)).alias("n"))
            .select("series", F.expr(f"unix_seconds(cast(w.start AS timestamp)) div {hours * 3600}").alias("no"), "label", "n"))


def _periods(counts: DataFrame) -> DataFrame:
    """(series, no, n_rows, dominant): one row per series and period with rows."""
    return counts.groupBy("series", "no").agg(
        F.sum("n").alias("n_rows"), F.min(F.struct(-F.col("n"), "label"))["label"].alias("dominant"))


def _spikes_among(periods: DataFrame, sigmas: float, back: int, hours: int) -> DataFrame:
    """The periods above the last `back` before them, which are zeros where they have no row."""
    w = Window.partitionBy("series").orderBy("no").rangeBetween(-back, -1)
    over = lambda c: F.coalesce(F.sum(c).over(w), F.lit(0)) / F.lit(back)
    scored = periods.withColumn("mean", over(F.col("n_rows"))).withColumn("square", over(F.col("n_rows") * F.col("n_rows")))
    spread = F.sqrt(F.greatest(F.col("square") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    return (scored.withColumn("spread", spread)
            .filter((F.col("no") - F.col("first") >= back) & (F.col("n_rows") > F.col("mean") + F.lit(sigmas) * F.col("spread")))
            .withColumn("period", F.timestamp_seconds(F.col("no") * (hours * 3600))))


def calendar_spikes(rows: DataFrame, ts: str, label: str, series: str, sigmas: float = 2.0, back: int = 7,
                    hours: int = 24) -> DataFrame:
    """Spikes of each series against its last `back` periods, of which those without rows count as zeros.

    A period of `hours` can be a spike once `back` periods lie behind the first of its series.  The
    dominant label has the most rows (ties: first by name, null first).  Rows without a time are left
    out; null is a series of its own.  The windows run over one row per series and period.
    """
    timed = rows.filter(F.col(ts).isNotNull())
    periods = _periods(_period_counts(timed, F.window(ts, f"{hours} hours"), label, series, hours))
    first = F.min("no").over(Window.partitionBy("series"))
    return _spikes_among(periods.withColumn("first", first), sigmas, back, hours).select(*SPIKES)


SPIKES = ["series", "period", "n_rows", "mean", "spread", "dominant"]
RING = "series string, no long, n_rows long, first long"


class SpikeTables:
    """Spikes of a stream, and for each series its last periods and the number of its first one.

    Both tables commit a batch under its number, the spikes first: a batch that is delivered again, or one
    that died between the two, leaves them as one delivery does.
    """

    def __init__(self, spark: SparkSession, path: str, sigmas: float = 2.0, back: int = 7, hours: int = 24) -> None:
        self.sigmas, self.back, self.hours = sigmas, back, hours
        self.ring = StoredTable(spark, f"{path}/ring", RING)
        self.spikes = StoredTable(spark, f"{path}/spikes", "series string, period timestamp, n_rows long, "
                                                           "mean double, spread double, dominant string")

    def take(self, counts: DataFrame, batch: int, name: str = "spikes") -> None:
        """One batch of closed periods (series, no, label, n); a period comes whole, and after earlier ones of its series."""
        key = f"{name}-{batch}"
        if self.ring.has(key):
            return
        fresh = _periods(counts).persist()
        try:
            part = hashed_part("series")
            touched = [r[0] for r in fresh.select(part).distinct().collect()]       # the number of parts at most
            if not touched:
                return
            kept = self.ring.read(touched).withColumn("dominant", F.lit(None).cast("string")).withColumn("new", F.lit(False))
            own = Window.partitionBy("series")
            rows = (fresh.withColumn("first", F.col("no")).withColumn("new", F.lit(True)).unionByName(kept)
                    .withColumn("first", F.min("first").over(own)))
            self.spikes.append(_spikes_among(rows, self.sigmas, self.back, self.hours).filter("new"), key)
            latest = rows.withColumn("last", F.max("no").over(own)).filter(F.col("no") > F.col("last") - self.back)
            self.ring.replace(latest, part, key, touched)
        finally:
            fresh.unpersist()


def closed_periods(rows: DataFrame, ts: str, label: str, series: str, hours: int = 24, delay: str = "10 minutes") -> DataFrame:
    """(series, no, label, n) of a stream, once the watermark has passed a period.

    Rows without a time, and those that the watermark refuses, are left out.
    """
    timed = rows.withWatermark(ts, delay).filter(F.col(ts).isNotNull())
    return _period_counts(timed, F.window(ts, f"{hours} hours"), label, series, hours)


def stream_spikes(rows: DataFrame, ts: str, label: str, series: str, path: str, sigmas: float = 2.0, back: int = 7,
                  hours: int = 24, delay: str = "10 minutes") -> SpikeTables:
    """`calendar_spikes` of a stream, into stored tables under `path`; it can be stopped and started again.

    Rows are counted per series, period and label, combined per task, so a series is advanced by a few
    numbers per period however many rows it has, and only its last `back` periods are read again.
    """
    tables = SpikeTables(rows.sparkSession, path, sigmas, back, hours)
    query = (closed_periods(rows, ts, label, series, hours, delay).writeStream.outputMode("append")
             .foreachBatch(lambda counts, n: tables.take(counts, n))
             .option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    return tables
