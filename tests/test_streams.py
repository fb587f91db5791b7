"""Streams give what the batch operators give, minus what came too late."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parley.operators import calls as C
from parley.streaming import streams as R

SCHEMA = ("call_id string, turn_index int, speaker string, text string, start_time double, "
          "end_time double, event_time timestamp")
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def turn(call, i, seconds, text="I want a refund", speaker="customer"):
    return (call, i, speaker, text, float(seconds), float(seconds + 5),
            T0 + dt.timedelta(seconds=seconds))


@pytest.fixture
def files(spark, tmp_path):
    def write(*batches):
        """One file per batch, read one file per micro-batch in this order."""
        import os
        for n, rows in enumerate(batches):
            out = tmp_path / f"b{n}"
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(out))
            for p in out.glob("*.parquet"):
                os.utime(p, (1_000_000_000 + n, 1_000_000_000 + n))
        return R.read_table(spark, str(tmp_path / "b*"), spark.createDataFrame([], SCHEMA).schema,
                            files_per_trigger=1)
    return write


def test_rollup_drops_late_turns(spark, files):
    early = [turn("A", 0, 0), turn("A", 1, 20, "ok fine", "agent")]
    later = [turn("B", 0, 4000), turn("Z", 0, 9000)]
    late = [turn("A", 2, 30)]
    # the watermark that drops late rows is one micro-batch behind
    got = R.run_to_table(R.stream_call_rollup(files(
        early, later, [turn("Z", 1, 9010)], late, [turn("Z", 2, 9020)])), "rollup")
    rows = {r["call_id"]: r for r in got.collect()}
    assert set(rows) == {"A", "B"}                       # Z is still open
    assert rows["A"]["total_segments"] == 2              # the third turn came too late
    batch = C.roll_up_calls(C.analyze_segments(spark.createDataFrame(early, SCHEMA))).collect()[0]
    for c in ("overall_intent", "overall_importance", "requires_enrichment",
              "high_priority_segments"):
        assert rows["A"][c] == batch[c]
    assert rows["A"]["weighted_score"] == pytest.approx(batch["weighted_score"], abs=1e-6)


def test_dedupe_and_triage(spark, files):
    one, other = [turn("A", 0, 0), turn("A", 1, 5, "ok")], [turn("A", 0, 0), turn("B", 0, 8)]
    stream = files(one, other)
    once = R.run_to_table(R.stream_dedupe(stream), "once")
    assert sorted((r["call_id"], r["turn_index"]) for r in once.collect()) == [
        ("A", 0), ("A", 1), ("B", 0)]
    alerts = R.run_to_table(R.stream_triage(R.stream_dedupe(stream)), "alerts")
    assert sorted(r["segment_id"] for r in alerts.collect()) == ["A_SEG_000", "B_SEG_000"]


def test_progress_and_final(spark, files):
    stream = files([turn("A", 0, 0), turn("A", 1, 10)], [turn("A", 2, 20)],
                   [turn("Z", 0, 9000)], [turn("Z", 1, 9010)])
    got = R.run_to_table(R.progressive_summary_final(stream), "final").collect()
    a = sorted((r["part"], r["n_turns"], r["is_final"]) for r in got if r["call_id"] == "A")
    assert a == [(1, 2, False), (2, 3, False), (3, 3, True)]
    assert not any(r["is_final"] for r in got if r["call_id"] == "Z")
    windows = R.run_latest(R.progressive_summary(stream), "progress", ["call_id", "window_start"])
    assert sorted((r["call_id"], r["n_turns"]) for r in windows.collect()) == [("A", 3), ("Z", 2)]


def test_spikes(spark):
    rows = [(dt.datetime(2024, 1, d), "x") for d in range(1, 11) for _ in range(3)]
    rows += [(dt.datetime(2024, 1, 9), "b")] * 7 + [(dt.datetime(2024, 1, 9), "a")] * 7
    df = spark.createDataFrame(rows, "ts timestamp, label string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    got = R.volume_spikes(df, "ts", "label").collect()
    assert [(r["period"].day, r["n_rows"], r["dominant"]) for r in got] == [(9, 17, "a")]


def test_calls_of_one_group_keep_their_own_state(spark, files, monkeypatch):
    """Python is called per group of calls, not per call; a call's rows don't depend on the group's others."""
    monkeypatch.setattr(R, "CALL_GROUPS", 1)
    stream = files([turn("A", 0, 0), turn("B", 0, 0), turn("A", 1, 10)], [turn("B", 1, 250)], [turn("Y", 0, 1100)],
                   [turn("Z", 0, 9000)], [turn("Z", 1, 9010)])
    got = sorted((r["call_id"], r["part"], r["n_turns"], r["is_final"])
                 for r in R.run_to_table(R.progressive_summary_final(stream), "final").collect())
    assert got == [("A", 1, 2, False), ("A", 2, 2, True), ("B", 1, 1, False), ("B", 2, 2, False), ("B", 3, 2, True),
                   ("Y", 1, 1, False), ("Y", 2, 1, True), ("Z", 1, 1, False), ("Z", 2, 2, False)]
    live = sorted((r["call_id"], r["part"], r["n_turns"], r["is_final"])
                  for r in R.run_to_table(R.live_summaries(stream), "live").collect())
    assert live == [("A", 1, 2, True), ("B", 1, 2, True), ("Y", 1, 1, True)]


def test_a_list_of_times_is_as_many_turns(spark, tmp_path, monkeypatch):
    """Turns of an id that several calls share are scored once, and counted as if they came at the time of each call."""
    monkeypatch.setattr(R, "COUNTED_TIMES", 3)
    said = ["I want a refund, this is fraud and terrible", "ok fine", "great, thank you", "I hate this error"]
    starts = {"A": [0, 0, 250, 4000], "B": [100], "C": [0, 590, 1200], "Z": [9000, 9000]}
    rows = [(c, i, "customer" if i % 2 else "agent", said[(i + ord(c)) % 4], 10.0 * i, 10.0 * i + 5,
             [T0 + dt.timedelta(seconds=at + 10 * i) for at in ats]) for c, ats in starts.items() for i in [0, 1, 1, 2, 3]]
    listed = spark.createDataFrame(rows, SCHEMA.replace("event_time timestamp", "event_time array<timestamp>"))
    single = listed.withColumn("event_time", F.explode("event_time"))
    streams = []
    for name, df in (("listed", listed), ("single", single)):
        df.coalesce(2).write.parquet(str(tmp_path / name))
        streams.append(lambda name=name, df=df: R.read_table(spark, str(tmp_path / name), df.schema))
    drained = lambda f, out: sorted(map(tuple, R.run_to_table(f, out).collect()), key=repr)
    for operator in (R.stream_call_rollup, R.stream_calls, R.progressive_summary_final, R.live_summaries):
        got, want = (drained(operator(stream()), operator.__name__) for stream in streams)
        assert want and got == want
    got, want = (sorted(map(tuple, R.run_latest(R.progressive_summary(stream()), "p", ["call_id", "window_start"]).collect()))
                 for stream in streams)
    assert want and got == want
