"""Sketched operation logs, language models and live summaries against exact counts."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from parley.operators import governance as G
from parley.operators import languages as L
from parley.operators import sketches as X
from parley.plans.workspace import new_path
from parley.streaming import streams as R
from tests.test_streams import SCHEMA, T0, files, turn    # noqa: F401 (a fixture)

LOG = "ts timestamp_ntz, user_id long, mode string, latency_ms double, is_error boolean, cache_hit boolean, cost double"


def operations(n, seed=1, hot=0.34):
    """A third of all rows in one hour, long-tailed latencies, some of them missing."""
    rng = random.Random(seed)
    for _ in range(n):
        hours = 5 if rng.random() < hot else rng.randrange(24 * 40)
        ts = dt.datetime(2024, 1, 20) + dt.timedelta(hours=hours, seconds=rng.randrange(3600))
        yield (ts, rng.randrange(3000), rng.choice(["deep", "cheap", None]),
               None if rng.random() < .01 else rng.lognormvariate(5, 1), rng.random() < .1, rng.random() < .5, .25)


def test_spans_from_sketches(spark):
    data = list(operations(40_000))
    log = spark.createDataFrame(data, LOG)
    kept = X.OperationLog(spark, new_path(spark, "kept"))
    for i, part in enumerate(log.randomSplit([.5, .3, .2], 7)):
        for _ in range(1 + (i == 1)):                              # one is delivered twice
            kept.add(part, f"b{i}")
    before = [tuple(r) for r in kept.spans("month").select("span", "n", "cost").orderBy("span").collect()]
    kept.compact("all")
    kept.compact("all")
    assert kept.table.read().groupBy("hour", "mode").count().filter("count > 1").isEmpty()
    months = kept.spans("month").orderBy("span")
    got = months.collect()
    assert [(r.span, r.n, r.cost) for r in got] == before
    for r in got:
        own = [d for d in data if (d[0].year, d[0].month) == (r.span.year, r.span.month)]
        users = len({d[1] for d in own})
        assert r.n == len(own) and r.cost == pytest.approx(.25 * len(own))
        assert r.error_rate == pytest.approx(sum(d[4] for d in own) / len(own))
        assert abs(r.n_users - users) <= 3 * X.user_error() * users
    off = X.quantile_errors(months, log, "month").collect()
    assert len(off) == len(got)
    assert all(r[f"{p}_error"] <= 2 * X.rank_error() for r in off for p, _ in X.QUANTILES)
    some = kept.spans("day", "mode", start="2024-01-25", end="2024-01-27").collect()
    assert sum(r.n for r in some) == sum(dt.datetime(2024, 1, 25) <= d[0] < dt.datetime(2024, 1, 27) for d in data)
    assert {r.mode for r in some} == {"deep", "cheap", None}


def test_small_sketches_are_exact_and_may_be_empty(spark):
    data = list(operations(600, 3, hot=1.1))
    hours = X.sketch_hours(spark.createDataFrame(data, LOG))
    r = X.figures(X.merge(hours)).first()
    known = sorted(d[3] for d in data if d[3] is not None)
    assert [r.p50, r.p95, r.p99] == [known[math.ceil(q * len(known)) - 1] for _, q in X.QUANTILES]
    none = [(dt.datetime(2024, 1, 1), None, None, None, None, None, None)]
    r = X.figures(X.merge(X.sketch_hours(spark.createDataFrame(none, LOG)), "hour")).first()
    assert (r.n, r.p50, r.p99, r.n_users, r.error_rate) == (1, None, None, 0, 0.0)
    empty = X.OperationLog(spark, new_path(spark, "none"))
    empty.add(spark.createDataFrame([], LOG), "b")
    assert empty.spans("day").collect() == []
    empty.compact("all")
    assert empty.spans("day").collect() == []


def test_all_alerts_on_a_stream(spark, tmp_path):
    hour = lambda h, **kw: [{"ts": dt.datetime(2024, 1, 1, h, m), "user_id": m, "mode": "cheap", "latency_ms": 100.0,
                             "is_error": False, "cache_hit": True, "cost": 1.0} | kw for m in range(60)]
    rows = [*hour(0), *hour(1, is_error=True), *hour(2, latency_ms=10_001.0), *hour(3, cost=2.0), *hour(4, cache_hit=False),
            *hour(5, mode="deep")]
    schema = LOG.replace("timestamp_ntz", "timestamp")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = R.read_table(spark, str(tmp_path / "log"), schema, files_per_trigger=1)
    got = G.alert_rules(R.run_latest(X.stream_hours(stream), "hours", ["hour"])).collect()
    assert sorted((r.hour.hour, r.alert) for r in got) == [
        (1, "HighErrorRate"), (2, "HighLatency"), (3, "CostSpike"), (4, "LowCacheHitRate"), (5, "HighEnrichmentRate")]


# --- languages --------------------------------------------------------------
def test_grams(spark):
    texts = ["Ab, cd", "É x", "", None, "12 --", "a", "x" * 5, "ñandú ok"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string").select("i", L.grams(F.col("t")).alias("g"))
    got = {r.i: sorted(r.g) for r in df.collect()}
    for i, x in enumerate(texts):
        words = "".join(c if c.isalpha() else " " for c in (x or "").lower()).split()
        padded = f" {' '.join(words)} " if words else ""
        assert got[i] == sorted(padded[k:k + 3] for k in range(len(padded) - 2))


def test_language_model(spark):
    english = "the quick answer is that we have to think about the other thing with the people there"
    german = "der schnelle hund und die katze gehen nicht auf den berg weil das wetter schlecht ist"
    rng = random.Random(5)

    def text(words, n=12):
        return " ".join(rng.choice(words.split()) for _ in range(n))
    train = [(i, text(english if i % 2 else german), "en" if i % 2 else "de") for i in range(60)] + [(99, "the", None), (98, None, "en")]
    model = L.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"), texts=25, vocabulary=100)
    assert model.languages == ("de", "en") and model.table.count() <= 200
    held = [(i, text(english if i % 2 else german), "en" if i % 2 else "de") for i in range(40)]
    odd = [(100, "", None), (101, None, None), (102, "qqq zzz xyx vvvk", None), (103, "дом и кот", None), (None, "the people there", None),
           (104, english * 4000, "en")]
    scored = {r.doc_id: r for r in L.score(spark.createDataFrame(held + odd, "doc_id long, text string, lang string")
                                           .withColumn("gram", F.lit("clash")), model).collect()}
    assert all(scored[i].language == lang for i, _, lang in held)
    assert [scored[i].language for i in (100, 101, 102, 103)] == [L.UNKNOWN] * 4
    assert scored[None].language == "en" and scored[104].language == "en"
    assert scored[101].n_grams == 0 and scored[104].n_grams > 300_000
    nothing = L.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert nothing.languages == ()
    assert [r.language for r in L.score(spark.createDataFrame([(1, "the")], "doc_id long, text string"), nothing).collect()] == [L.UNKNOWN]


# --- live summaries ---------------------------------------------------------
def expected(turns, mark, every=600, gap=300):
    """(call, session start, part, until, turns, critical, final), from whole calls; seconds."""
    out, calls = set(), {}
    for c, at, crit in turns:
        calls.setdefault(c, []).append((at, crit))
    for c, own in calls.items():
        sessions = []
        for at, crit in sorted(own):
            if sessions and at - sessions[-1][-1][0] < gap:
                sessions[-1].append((at, crit))
            else:
                sessions.append([(at, crit)])
        for s in sessions:
            start, end = s[0][0], s[-1][0] + gap
            edges = [*range(start + every, end, every), end]
            for part, until in enumerate(edges, 1):
                seen = [crit for at, crit in s if at < until]
                if until < mark:
                    out.add((c, start, part, until, len(seen), sum(seen), until == end))
    return out


def test_a_call_moves_on_the_same_in_any_pieces():
    rng = random.Random(8)
    for _ in range(300):
        ats = sorted(rng.choice([0, 60, 299, 300, 301, 600, 601, 900, 1200, 1800, rng.randrange(4000)]) for _ in range(rng.randrange(1, 14)))
        turns = [("c", at, rng.randrange(2)) for at in ats]
        todo, state, rows, mark = list(turns), (0, 0, 0, 0, 0, []), [], -1
        rng.shuffle(todo)
        todo.sort(key=lambda t: t[1] // 500)                       # out of order, within the delay
        while mark < 6000:
            mark += rng.choice([7, 100, 450, 2500])
            new = [t for t in todo if t[1] // 500 * 500 <= mark + 500]     # all up to the mark, and some beyond
            todo = todo[len(new):]
            state, more = R.advance_call(state, [2 * t[1] + t[2] for t in new], mark, 600, 300)
            rows += more
        assert len(rows) == len(set(rows))
        assert {("c", *r) for r in rows} == expected(turns, mark)


@pytest.mark.parametrize("pieces", [1, 4])
def test_live_summaries_do_not_depend_on_batches(spark, files, pieces):     # noqa: F811
    rng = random.Random(2)
    turns = [(c, at, text) for c in "ABC" for at in sorted(rng.sample(range(0, 5000, 7), 40))
             for text in [rng.choice(["I want a refund, this is fraud and terrible", "ok fine"])]]
    turns += [("Z", 9000, "ok"), ("Z", 9010, "ok")]
    turns.sort(key=lambda t: t[1])
    rows = [turn(c, i, at, text) for i, (c, at, text) in enumerate(turns)]
    critical = {r.turn_index for r in R.analyze_segments_with(spark.createDataFrame(rows, SCHEMA)).filter("is_critical").collect()}
    want = expected([(c, at, int(i in critical)) for i, (c, at, _) in enumerate(turns)], 9010 - 600)
    seconds = lambda t: int((t - T0).total_seconds())
    size = -(-len(rows) // pieces)
    stream = files(*[rows[k:k + size] for k in range(0, len(rows), size)])
    got = [(r.call_id, seconds(r.started), r.part, seconds(r.until), r.n_turns, r.n_critical, r.is_final)
           for r in R.run_to_table(R.live_summaries(stream), "live").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert any(not r[-1] for r in got)


def test_closed_calls_have_all_columns_and_late_turns_are_counted(spark, files):     # noqa: F811
    from parley.operators import calls as C
    early = [turn("A", 0, 0), turn("A", 1, 20, "ok fine", "agent"), turn("B", 0, 30, "great, thank you")]
    late = [turn("A", 2, 30), turn("A", 3, 31)]
    received = [*early, turn("Y", 0, 4000), turn("Z", 0, 9000), turn("Z", 1, 9010), *late, turn("Z", 2, 9020)]
    stream = files(early, received[3:5], received[5:6], late, received[-1:])
    rolled = R.run_to_table(R.stream_calls(stream), "calls")
    batch = C.roll_up_calls(C.analyze_segments(spark.createDataFrame(early, SCHEMA)))
    assert rolled.columns == batch.columns
    assert sorted(map(tuple, rolled.filter("call_id <> 'Y'").collect())) == sorted(map(tuple, batch.collect()))
    counted = R.late_turns(spark.createDataFrame(received, SCHEMA), rolled).collect()
    assert {r.call_id: (r.n_received, r.n_late) for r in counted} == {"A": (4, 2), "B": (1, 0), "Y": (1, 0)}
