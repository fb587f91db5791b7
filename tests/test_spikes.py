"""Spikes on a calendar with gaps: a plain loop, the batch operator and the stream agree."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from parley.sources.stored import StoredTable
from parley.streaming import streams as R

T0, SCHEMA = dt.datetime(2024, 1, 1), "ts timestamp, s string, l string"


def some_rows(days=45):
    """Three series, one of them null, with random days off and a long silence."""
    rnd, rows = random.Random(5), []
    for day in range(days):
        for s, odds in (("a", .7), ("b", .95), (None, .5)):
            if rnd.random() < odds and not 20 <= day <= (31 if s == "b" else 24):
                rows += [(T0 + dt.timedelta(days=day, seconds=rnd.randrange(86400)), s, rnd.choice(["x", "y", None]))
                         for _ in range(rnd.choice([1, 2, 2, 3, 3, 12]))]
    return sorted(rows, key=lambda r: r[0])


def by_loop(rows, sigmas=2.0, back=7):
    """(series, day, rows, mean, spread, label), the calendar walked day by day."""
    out = []
    for s in {r[1] for r in rows}:
        own = [((r[0] - T0).days, r[2]) for r in rows if r[1] == s]
        n = lambda day: sum(d == day for d, _ in own)
        first, last = min(own, key=lambda r: r[0])[0], max(own, key=lambda r: r[0])[0]
        for day in range(first + back, last + 1):
            before = [n(d) for d in range(day - back, day)]
            mean = sum(before) / back
            spread = max(sum(x * x for x in before) / back - mean * mean, 0) ** .5
            if n(day) > mean + sigmas * spread:
                labels = [x for d, x in own if d == day]
                best = min(set(labels), key=lambda x: (-labels.count(x), x is not None, x or ""))
                out.append((s, T0 + dt.timedelta(days=day), n(day), mean, spread, best))
    return sorted(out, key=str)


def plain(df):
    return sorted((tuple(r) for r in df.select(*R.SPIKES).collect()), key=str)


def test_calendar_with_gaps(spark):
    rows = some_rows()
    df = spark.createDataFrame([*rows, (None, "a", "x")], SCHEMA)
    want = by_loop(rows)
    assert len(want) > 10 and plain(R.calendar_spikes(df, "ts", "l", "s")) == want
    assert plain(R.calendar_spikes(df, "ts", "l", "s", sigmas=1.0, back=3)) == by_loop(rows, 1.0, 3)
    assert plain(R.calendar_spikes(df.limit(0), "ts", "l", "s")) == []


@pytest.mark.parametrize("per_file", [60, 10_000])
def test_stream_gives_the_same(spark, tmp_path, per_file):
    rows = some_rows()
    rows.append((T0 + dt.timedelta(days=60), "a", "x"))          # closes all days before
    for n in range(0, len(rows), per_file):
        out = tmp_path / f"b{n:06d}"
        spark.createDataFrame([*rows[n:n + per_file], (None, "a", "x")], SCHEMA).coalesce(1).write.parquet(str(out))
        for p in out.glob("*.parquet"):
            os.utime(p, (1_000_000_000 + n, 1_000_000_000 + n))
    stream = R.read_table(spark, str(tmp_path / "b*"), spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    kept = R.stream_spikes(stream, "ts", "l", "s", str(tmp_path / "out"))
    assert plain(kept.spikes.read()) == by_loop(rows[:-1])
    ring = kept.ring.read().groupBy("series").agg(F.count("*").alias("n"), (F.max("no") - F.min("no")).alias("span"))
    assert all(r["n"] <= 7 and r["span"] < 7 for r in ring.collect())


def test_batches_delivered_again(spark, tmp_path, monkeypatch):
    """A batch delivered twice, or one that died between the two tables, counts once."""
    rows = some_rows(30)
    df = spark.createDataFrame(rows, SCHEMA)
    counts = R._period_counts(df, F.window("ts", "24 hours"), "l", "s", 24)
    day = F.col("no") - F.lit((T0 - dt.datetime(1970, 1, 1)).days)
    kept = R.SpikeTables(spark, str(tmp_path / "kept"))
    early, late = counts.filter(day < 14), counts.filter(day >= 14)
    kept.take(early, 0)
    kept.take(early, 0)
    with monkeypatch.context() as m:
        m.setattr(StoredTable, "replace", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            kept.take(late, 1)
    kept.take(late, 1)
    kept.take(counts.limit(0), 2)
    assert plain(kept.spikes.read()) == by_loop(rows)
