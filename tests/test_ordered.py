"""Ordered work: cutting calls into small blocks must not change any result."""

import random

import pytest
from pyspark.sql import functions as F

from parley.operators import calls as C
from parley.operators import summaries as M
from parley.operators import turns as O
from parley.plans import ordered
from parley.sources import transcripts as S

TEXTS = ["I want a refund now", "Hi, how are you today", "Please hold, one moment",
         "the app shows an error again", "the app shows an error again!", "Thank you for calling",
         "anything else I can do", "um like you know the price is wrong", "No", "Have a nice day",
         "The issue has been resolved", "my card my card my card"]


def long_calls(seed=3, calls=6, longest=40):
    rng = random.Random(seed)
    return {f"C{c}": [(rng.choice(["customer", "customer", "agent", "system"]), rng.choice(TEXTS))
                      for _ in range(rng.randint(1, longest))] for c in range(calls)}


def rows(df):
    names = sorted(df.columns)
    return sorted([tuple(r[n] for n in names) for r in df.collect()], key=repr)


OPERATORS = {
    "roll_up": lambda t: C.roll_up_calls(C.analyze_segments(t)).withColumn(
        "importance_score", F.round("importance_score", 9)).withColumn(
        "weighted_score", F.round("weighted_score", 9)),
    "repetitions": O.remove_repetitions,
    "repetitions_lag": O.remove_repetitions_lag,
    "customer_repeats": O.dedupe_customer_turns,
    "pause_gap": O.pause_gap,
    "topics": O.topic_boundaries,
    "chunks": O.semantic_chunks,
    "noise_filter": M.noise_filter,
    "noise_filter_full": M.noise_filter_full,
    "merged": lambda t: O.merge_small_segments(O.segment_table(O.topic_boundaries(t)), 12),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_small_blocks_change_nothing(spark, turns, monkeypatch, name):
    table = turns(long_calls()).cache()
    want = rows(OPERATORS[name](table))
    monkeypatch.setattr(ordered, "TURN_BLOCK", 5)
    assert rows(OPERATORS[name](table)) == want
    assert want


def test_runs_in_parts_join_to_the_whole(spark, turns):
    table = turns(long_calls()).cache()
    want = {(r["call_id"], r["run"]): r["run_text"] for r in O.speaker_runs(table).collect()}
    parts = {}
    for r in O.speaker_runs(table, part_turns=2).orderBy("call_id", "run", "part").collect():
        parts.setdefault((r["call_id"], r["run"]), []).append(r["run_text"])
    assert {k: " ".join(v) for k, v in parts.items()} == want


def test_transcript_parts_join_to_the_whole(spark, turns):
    table = turns(long_calls()).cache()
    want = {r["call_id"]: r["transcript_text"] for r in S.assemble_transcript(table).collect()}
    parts = {}
    for r in S.assemble_transcript(table, part_turns=4).orderBy("call_id", "part").collect():
        parts.setdefault(r["call_id"], []).append(r["transcript_text"])
    assert {k: "\n".join(v) for k, v in parts.items()} == want


def similarity(a, b):
    x, y = ({t[i:i + 3] for i in range(len(t) - 2)} for t in (a, b))
    return len(x & y) / len(x | y) if x and y else 0.0


def test_repetitions_by_brute_force(spark, turns):
    calls = long_calls(seed=8)
    want = []
    for c, ts in calls.items():
        kept = {}
        for i, (s, x) in enumerate(ts):
            recent = kept.setdefault(s, [])
            if not any(similarity(x, r) > 0.85 for r in recent[-3:]):
                recent.append(x)
                want.append((c, i))
    got = [(r["call_id"], r["turn_index"]) for r in O.remove_repetitions(turns(calls)).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("target", [4, 10, 37])
def test_greedy_selection_by_brute_force(spark, turns, target):
    rng = random.Random(target)
    calls = {f"C{c}": [("agent", " ".join(["w"] * rng.randint(0, 9))) for _ in range(30)]
             for c in range(4)}
    scores = {(c, i): rng.randint(0, 5) / 10 for c, ts in calls.items() for i in range(len(ts))}
    table = turns(calls)
    scored = table.join(spark.createDataFrame(
        [(c, i, s) for (c, i), s in scores.items()], "call_id string, turn_index int, score double"),
        ["call_id", "turn_index"])
    want = []
    for c, ts in calls.items():
        used = 0
        for i in sorted(range(len(ts)), key=lambda i: (-scores[c, i], i)):
            n = len(ts[i][1].split())
            if used + n <= target:
                used += n
                want.append((c, i))
    got = [(r["call_id"], r["turn_index"]) for r in O.extractive_select(scored, target).collect()]
    assert sorted(got) == sorted(want)


def test_budget_stops_where_selection_skips(spark):
    items = spark.createDataFrame([(1, 5), (2, 9), (3, 4)], "rank int, n int").withColumn(
        "q", F.lit("q"))
    got = O.context_budget(items, ["q"], "rank", F.col("n"), 10)
    assert [r["rank"] for r in got.collect()] == [1]


def test_trim_bounds(spark, turns):
    hi, x = ("agent", "hello"), ("agent", "content here")
    calls = {"five": [hi] * 5, "six": [hi] * 6, "ends": [hi, hi, x, x, x, hi],
             "late": [hi] * 7 + [x]}
    kept = {c: 0 for c in calls}
    for r in O.trim_opening_closing(turns(calls)).collect():
        kept[r["call_id"]] += 1
    assert kept == {"five": 5, "six": 6, "ends": 3, "late": 8}


def test_semantic_chunks_by_brute_force(spark, turns):
    calls = long_calls(seed=11, calls=3)
    sims = {}
    for r in O.adjacent_cosine(turns(calls)).filter(~F.col(ordered.HALO)).collect():
        sims.setdefault(r["call_id"], {})[r["turn_index"]] = r["next_similarity"]
    want = []
    for c, ts in calls.items():
        s = [sims[c][i] for i in range(len(ts) - 1)]
        starts = {i + 1 for i in range(len(s) - 3) if round(sum(s[i:i + 3]) / 3, 6) < 0.65}
        seg = 0
        for i in range(len(ts)):
            seg += i in starts
            want.append((c, i, seg))
    got = [(r["call_id"], r["turn_index"], r["segment"])
           for r in O.semantic_chunks(turns(calls)).collect()]
    assert sorted(got) == sorted(want)


def test_hierarchical_summary(spark, turns):
    calls = long_calls(seed=4, calls=3)
    got = M.hierarchical_summary(turns(calls), max_words=30, per_segment=15).collect()
    numbers = {}
    for r in got:
        numbers.setdefault(r["call_id"], []).append(r["segment_number"])
        assert len(r["summary"].split("\n")) <= 3 and r["time_range"].endswith("s")
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in numbers.values())
    whole = {r["call_id"]: r["summary"] for r in M.final_summary(
        M.hierarchical_summary(turns(calls), max_words=30, per_segment=15)).collect()}
    for r in got:
        assert r["summary"] in whole[r["call_id"]]


def test_example_call(spark, turns):
    call = [("agent", "Good morning! Thank you for calling. My name is Sarah. How can I help you?"),
            ("customer", "Hi Sarah, how are you today?"),
            ("agent", "Can you provide your account number please?"),
            ("customer", "Sure, it is 123456789"),
            ("customer", "I am having a terrible issue with my credit card. I was charged twice this month."),
            ("agent", "I apologize for that issue. Let me check your billing history."),
            ("customer", "This is really frustrating. I need this fixed immediately."),
            ("agent", "I completely understand. I see the duplicate charge and I am processing a refund right now.")]
    text = M.extractive_summary(turns({"T": call}), "fast").collect()[0]["summary"]
    assert "how are you" not in text and "account number" not in text
    assert text.startswith("customer: Sure, it is 123456789 I am having a terrible issue")
    empty = M.extractive_summary(turns({"E": [("agent", "No"), ("agent", "Ok")]})).collect()
    assert empty[0]["summary"] == "No significant content found."


def test_lcs():
    assert M._lcs_length(list("abcbdab"), list("bdcaba")) == 4
    assert M._lcs_length([], list("a")) == 0
    rng = random.Random(1)
    for _ in range(50):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 9))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1],
                                                                        table[i + 1][j])
        assert M._lcs_length(a, b) == table[-1][-1]


def test_short_calls_are_not_computed_again(spark, monkeypatch):
    """Where no call is beyond a block, positions and running sums need no second pass over their input."""
    df = spark.createDataFrame([("a", i, i % 2) for i in range(4)] + [("b", 7, 1)], "k string, i int, v int")
    passes = []
    whole = ordered._add_block_offsets
    monkeypatch.setattr(ordered, "_add_block_offsets", lambda *a: passes.append(1) or whole(*a))
    for bound, n in ((df, 0), (None, 2), (df.withColumn("i", F.col("i") * 1000), 4), (df.withColumn("i", -F.col("i")), 6)):
        numbered = ordered.dense_position(df, ["k"], "i", bound=bound)
        summed = ordered.running_total(df, ["k"], "i", F.col("v"), "s", bound=bound)
        assert rows(numbered.select("i", "pos")) == [(0, 0), (1, 1), (2, 2), (3, 3), (7, 0)]
        assert rows(summed.select("i", "s")) == [(0, 0), (1, 1), (2, 1), (3, 2), (7, 1)]
        assert len(passes) == n
