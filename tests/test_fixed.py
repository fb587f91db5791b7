"""Cases the tables do not show: long calls, odd ids, repeated results, failing models."""

import math
from datetime import datetime, timedelta

import pytest

from parley.operators import calls as C
from parley.operators import enrichment as N
from parley.operators import questions as Q
from parley.operators import summaries as M
from parley.operators import turns as O
from parley.sources import transcripts as S

LONG = 9_500


@pytest.fixture(scope="module")
def long_call(spark):
    rows = [("L", i, "customer" if i % 3 else "agent",
             ("I want a refund, this is terrible" if i % 7 == 0 else f"turn number {i} of the card call"),
             float(i), i + .5) for i in range(LONG)]
    return spark.createDataFrame(rows, "call_id string, turn_index int, speaker string, text string, "
                                       "start_time double, end_time double")


def test_long_call_rolls_up_exactly(spark, long_call):
    segments = C.analyze_segments(long_call)
    got = C.roll_up_calls(segments).first()
    rows = segments.select("turn_index", "speaker", "importance_score", "is_critical").collect()
    mean = lambda scores: math.fsum(scores) / len(scores)           # exact sums, rounded once
    c, a = ([r.importance_score for r in rows if r.speaker == who] for who in ("customer", "agent"))
    assert got.weighted_score == mean(c) * .7 + mean(a) * .3
    assert got.importance_score == mean(c + a)
    assert got.total_segments == LONG and got.high_priority_segments == sum(r.is_critical for r in rows)
    plan = C.roll_up_calls(segments)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan


@pytest.mark.parametrize("part_turns", [None, 7, 4096])
def test_long_call_keeps_its_turn_numbers(long_call, part_turns):
    back = S.explode_turns(S.nest_turns(long_call, part_turns))
    ids = [r.segment_id for r in back.select("segment_id").collect()]
    assert len(ids) == len(set(ids)) == LONG
    a = {(r.turn_index, r.text) for r in back.collect()}
    assert a == {(r.turn_index, r.text) for r in long_call.collect()}


def test_long_call_is_one_text(long_call):
    text = S.assemble_transcript(long_call).collect()
    assert len(text) == 1 and text[0].transcript_text.count("\n") == LONG - 1
    assert M.extractive_summary(long_call, "fast").count() == 1


def test_long_run_is_one_run(spark):
    rows = [("L", i, "agent" if 4_000 <= i < 5_000 else f"s{i % 2}", f"t{i}", 0., 0.) for i in range(6_000)]
    table = spark.createDataFrame(rows, "call_id string, turn_index int, speaker string, text string, "
                                        "start_time double, end_time double")
    runs = O.speaker_runs(table).collect()
    assert len(runs) == 5_001 and {r.part for r in runs} == {0}
    assert " ".join(f"t{i}" for i in range(4_000, 5_000)) in {r.run_text for r in runs}


def test_ids_with_hashes(spark, turns):
    table = turns({"A#1": [("customer", "fraud on the card"), ("agent", "hello there")],
                   "A": [("customer", "hello"), ("agent", "fraud again")]})
    got = {(r.call_id, r.turn_index) for r in M.query_focused_turns(table, "fraud card").collect()}
    assert got == {("A#1", 0), ("A", 1)}


def test_one_row_per_request(spark):
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    stored = spark.createDataFrame([("c", "fast", day(d)) for d in (0, 10, 100)],
                                   "call_id string, quality string, created_at timestamp")
    asked = spark.createDataFrame([(i, "c", "fast", day(d)) for i, d in enumerate((-1, 0, 35, 40, 100, 300))]
                                  + [(9, "d", "fast", day(0))],
                                  "id int, call_id string, quality string, requested_at timestamp")
    got = {r.id: r.reused for r in M.summary_reuse(asked, stored).collect()}
    assert got == {0: False, 1: True, 2: True, 3: False, 4: True, 5: False, 9: False}


def log(spark, rows):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame([(i, q, start + timedelta(minutes=m), f) for i, (q, m, f) in enumerate(rows)],
                                 "query_id int, query_text string, ts timestamp, region string")


def test_a_hit_does_not_renew_its_result(spark):
    table = log(spark, [("a", 0, "x"), ("A ", 50, "x"), ("a", 100, "x"), ("a", 150, "x"), ("a", 160, "x"), ("a", 160, "y")])
    got = {r.query_id: r.cache_hit for r in Q.dedupe_queries(table).collect()}
    assert got == {0: False, 1: True, 2: False, 3: True, 4: True, 5: True}
    got = {r.query_id: r.cache_hit for r in Q.dedupe_queries(table, filters=("region",)).collect()}
    assert got == {0: False, 1: True, 2: False, 3: True, 4: True, 5: False}


def test_long_chains_of_hits(spark):
    minutes = list(range(0, 60 * 24 * 400, 50))            # over more than two blocks of time
    rows = Q.dedupe_queries(log(spark, [("q", m, "x") for m in minutes])).collect()
    want, stored = {}, None
    for i, m in enumerate(minutes):
        want[i] = stored is not None and m - stored <= 60
        stored = stored if want[i] else m
    assert {r.query_id: r.cache_hit for r in rows} == want


def test_failed_prompts_leave_the_call_pending(spark, turns):
    table = turns({"good": [("customer", "my card is broken")], "bad": [("customer", "refund the poison fee")]})
    plan = spark.createDataFrame([("good", "gpt-3.5-turbo"), ("bad", "gpt-3.5-turbo")], "call_id string, model string")

    def complete(prompts, models, limits):
        if any("poison" in p for p in prompts):
            raise RuntimeError("refused")
        return ["[]" for _ in prompts]

    outputs = N.apply_model(N.render_prompts(table, plan), complete)
    assert [r.call_id for r in N.assemble_enrichment(outputs).collect()] == ["good"]
    failed = N.failed_outputs(outputs).collect()
    assert {(r.call_id, r.error) for r in failed} == {("bad", "refused")} and len(failed) == 4
    assert outputs.filter("error IS NOT NULL").agg({"cost": "sum"}).first()[0] == 0


def test_long_prompts_are_sent_in_pieces(spark):
    """A whole Arrow batch of long prompts was held as Python objects, twice."""
    from parley.operators import enrichment as N
    prompts = spark.range(3, numPartitions=1).selectExpr(
        "string(id) AS call_id", "repeat('x', 3000000) AS prompt", "'gpt-4' AS model", "50 AS max_tokens")
    out = N.apply_model(prompts, lambda texts, models, limits: [str(len(texts))] * len(texts))
    assert sorted((r["call_id"], r["output"], r["error"]) for r in out.select("call_id", "output", "error").collect()) == [
        (str(i), "1", None) for i in range(3)]


def test_slots_of_many_tokens_are_counted_in_pieces():
    """Two lists of places as long as all tokens of a batch were made."""
    import tracemalloc

    import numpy as np
    import pandas as pd

    from parley.functions import vectors as V
    rows = [np.full(200_000, i % 8, "int32") for i in range(40)] + [None]
    tracemalloc.start()
    got = V.slot_vectors(pd.Series(rows), 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6 and all((got[i] == np.eye(8)[i % 8]).all() for i in range(40)) and not got[40].any()
