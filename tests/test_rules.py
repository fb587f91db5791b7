"""Scoring, roll-up and text rules on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from parley.functions import pii, triage
from parley.functions import text as X
from parley.functions import vectors as V
from parley.operators import calls as C
from parley.operators import questions as Q


def apply(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize("text,intent", [
    ("this is a COMPLAINT", "complaint"), ("I was charged incorrectly", "billing_dispute"),
    ("the bill is wrong", "technical_issue"), ("ok?", "inquiry"), ("", "general"),
    ("change my address", "account_management"), ("complaints are fine", "general"),
    ("charged 5 and disputed it", "billing_dispute")])
def test_intent(spark, text, intent):
    assert apply(spark, [text], triage.classify_intent) == [intent]


@pytest.mark.parametrize("text,sentiment", [
    ("bad and worst but great great love", "very_negative"), ("bad", "negative"),
    ("bad bad", "very_negative"), ("thanks a lot", "positive"), ("great thanks", "very_positive"),
    ("badly", "neutral")])
def test_sentiment(spark, text, sentiment):
    assert apply(spark, [text], triage.analyze_sentiment) == [sentiment]


def test_keyword_lists(spark):
    assert apply(spark, ["Errors and REFUNDS"], triage.high_keywords) == [["refund", "error"]]
    assert apply(spark, ["a dollar bill and my ira card"], triage.extract_products) == [
        ["credit card", "retirement fund"]]


def test_score_order_and_clamp(spark, turns):
    seg = C.analyze_segments(turns({"A": [
        ("agent", "thanks, how is it"),
        ("customer", "complaint refund fraud: terrible awful question problem")]})).orderBy("turn_index")
    low, high = seg.collect()
    assert low["importance_score"] == 0.3 + 0.15 - 0.05 < 0.4
    assert not low["requires_llm_enrichment"]
    assert high["importance_score"] == 1.0 and high["is_critical"]
    assert low["segment_id"] == "A_SEG_000"


def test_roll_up(spark, turns):
    pc = {r["call_id"]: r for r in C.roll_up_calls(C.analyze_segments(turns({
        "customer": [("customer", "I want a refund")],
        "agent": [("agent", "I want a refund")],
        "system": [("system", "refund complaint")],
        "tie": [("customer", "the bill is disputed"), ("customer", "I complain")],
        "two": [("agent", "terrible fraud")] * 2}))).collect()}
    assert pc["customer"]["weighted_score"] == pytest.approx(0.7 * pc["customer"]["importance_score"])
    assert pc["agent"]["weighted_score"] == pytest.approx(0.3 * pc["agent"]["importance_score"])
    assert pc["system"]["overall_importance"] == "low" and not pc["system"]["requires_enrichment"]
    assert pc["system"]["enrichment_reason"] is None
    assert pc["tie"]["overall_intent"] == "billing_dispute"
    assert pc["two"]["requires_enrichment"] and pc["two"]["high_priority_segments"] == 2


def test_reasons(spark):
    rows = spark.createDataFrame([("critical", "general", 0), ("high", "complaint", 3),
                                  ("high", "inquiry", 2), ("high", "inquiry", 1),
                                  ("low", "complaint", 1), ("low", "general", 4)],
                                 "level string, intent string, n bigint")
    got = [r[0] for r in rows.select(C.enrichment_reason(
        F.col("level"), F.col("intent"), F.col("n"))).collect()]
    assert got == ["Critical importance score", "Complaint detected", "2 high-priority segments",
                   None, None, "4 high-priority segments"]


def test_lists(spark):
    assert apply(spark, ['["a"]', "not json", '{"a":1}', None], X.decode_list) == [
        ["a"], ["not json"], ['{"a":1}'], None]
    assert apply(spark, ["  a  b ", "", " "], X.word_count) == [2, 0, 0]


def test_trigrams(spark):
    rows = spark.createDataFrame([("abcd", "abcd"), ("abcd", "wxyz"), ("ab", "ab"),
                                  ("abcd", "abce")], "a string, b string")
    got = [r[0] for r in rows.select(X.trigram_jaccard(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.0, 0.0, pytest.approx(1 / 3)]


def test_fillers_with_look_ahead(spark):
    assert apply(spark, ["I like to go, like, um now"], X.clean_fillers_full) == [
        "I like to go,, now"]


def test_redaction_order(spark):
    text = "card 4111 1111 1111 1111, ssn 123-45-6789, phone 555-123-4567, a@b.io"
    assert apply(spark, [text], pii.redact) == [
        "card [CREDIT_CARD], ssn [SSN], phone [PHONE], [EMAIL]"]


def test_vectors(spark):
    rows = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])],
                                 "a array<double>, b array<double>")
    got = rows.select(V.l2_normalize(F.col("a")), V.cosine(F.col("a"), F.col("b"))).collect()
    assert got[0][0] == [0.6, 0.8] and got[0][1] == pytest.approx(0.96)
    assert got[1][0] == [0.0, 0.0] and got[1][1] is None
    vec = spark.createDataFrame([("alpha beta beta",), ("",)], "x string").select(
        V.hashed_embedding(F.col("x"))).collect()
    assert math.isclose(sum(v * v for v in vec[0][0]), 1.0) and not any(vec[1][0])


def test_routing(spark):
    rows = spark.createDataFrame([(q,) for q in (
        "hello there", "Find and explain the top issue",
        "Find the number of etf calls and list them", "Explain the main concern of vip clients")],
        "query_text string")
    got = {r["query_text"]: r for r in Q.classify_queries(rows).collect()}
    none = got["hello there"]
    assert none["query_type"] == "hybrid" and none["confidence"] == 0
    assert not (none["route_to_analytics"] or none["route_to_search"] or none["route_to_rag"])
    mixed = got["Find and explain the top issue"]
    assert mixed["query_type"] == "hybrid" and mixed["route_to_analytics"] and mixed["route_to_rag"]
    assert got["Find the number of etf calls and list them"]["query_type"] == "search"
    assert got["Explain the main concern of vip clients"]["query_type"] == "insight"


def test_unknown_category_and_filter(spark):
    with pytest.raises(ValueError):
        C.count_by_category(None, None, "planet")
    rows = spark.createDataFrame([("a", 1)], "x string, y int")
    assert C.metadata_filter(rows, {"z": 1}).isEmpty()
    assert C.metadata_filter(rows, {"x": ["a", "b"], "y": 1}).count() == 1


def test_latency_sketch_is_close(spark):
    from parley.operators import governance as G
    log = spark.range(20000).select(F.lit("m").alias("mode"), (F.col("id") / 10).alias("latency_ms"),
                                    (F.col("id") % 50 == 0).alias("is_error"))
    got = G.latency_percentiles(log).collect()[0]
    assert got["n"] == 20000 and got["error_rate"] == 0.02
    for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        assert got[name] == pytest.approx(2000 * p, rel=0.002)


def test_call_lookup(spark, turns):
    """By list or table: one row per known id, segments in order, missing sides null."""
    segments = C.analyze_segments(turns({"a": [("agent", "hello"), ("customer", "fraud on my card")],
                                         "b": [("agent", "hi")]}))
    calls = spark.createDataFrame([("a", "loan"), ("b", "loan"), ("c", "loan")], "call_id string, product string")
    enrichments = spark.createDataFrame([("a", "short")], "call_id string, summary string")
    pc = C.roll_up_calls(segments)
    asked = spark.createDataFrame([("a",), ("a",), ("c",), ("gone",)], "call_id string")
    for ids in (["a", "c", "gone"], asked):
        got = {r["call_id"]: r for r in
               C.call_lookup(ids, calls, pc, enrichments, segments).collect()}
        assert set(got) == {"a", "c"} and got["a"]["summary"] == "short"
        assert [x["text"] for x in got["a"]["segments"]] == ["hello", "fraud on my card"]
        assert got["a"]["num_segments"] == 2 and got["a"]["overall_importance"] is not None
        assert got["c"]["segments"] is None and got["c"]["num_segments"] == 0


def test_tables_of_calls_are_not_broadcast(spark, turns):
    """Ids and repeated texts are small in files, so sizes alone would send them through the driver."""
    from parley.operators import enrichment as N
    rows = turns({"A": [("customer", "I want a refund for the card"), ("agent", "It has been resolved today")],
                  "B": [("customer", "My address has changed again")]})
    plan = spark.createDataFrame([("A", "m")], "call_id string, model string")
    out = N.model_outputs(rows, plan)
    assert out.count() == 4 and {r["call_id"] for r in out.collect()} == {"A"}
    from parley.operators.summaries import turn_salience
    for df in (out, turn_salience(rows), N.assemble_enrichment(out)):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_rouge_cuts_a_text_once(spark):
    """Bigrams come from words that are found once per text, not once per gram."""
    from parley.operators import summaries as M
    pairs = spark.createDataFrame([("a", "one two three two three", "two three one two"), ("b", "one", "one two")],
                                  "call_id string, summary string, reference string")
    out = M.rouge_n(pairs, "call_id", 2)
    got = {r.call_id: (round(r.precision, 6), round(r.recall, 6)) for r in out.collect()}
    assert got == {"a": (0.5, 0.666667), "b": (0.0, 0.0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2
