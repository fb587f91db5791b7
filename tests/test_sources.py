"""Documents in and out."""

import json

from pyspark.sql import functions as F

from parley.sources import transcripts as S


def document(call, turns, **extra):
    return {"call_id": call, "transcript": turns, "metadata": {
        "call_id": call, "client_id": "X", "call_timestamp": "2024-01-02T03:04:05"},
        "ingestion_timestamp": "2024-01-02T03:04:06", **extra}


def test_scan_validate_explode(spark, tmp_path):
    turn = {"speaker": "agent", "text": "hi", "start_time": 0, "end_time": 1, "duration": 1}
    files = {"a": json.dumps(document("A", [turn, turn], ground_truth_importance="high"), indent=2),
             "b": json.dumps(document("B", [])),
             "c": json.dumps({"call_id": "C", "transcript": [turn]}),
             "d": json.dumps({**document("D", []), "transcript": "none"}),
             "e": "{ not json"}
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    raw = S.scan_transcripts(spark, str(tmp_path))
    ok, rejects = S.split_valid(raw)
    assert [r["call_id"] for r in ok.collect()] == ["A"] and rejects.count() == 4
    call = S.call_metadata(ok).collect()[0]
    assert str(call["call_timestamp"]) == "2024-01-02 03:04:05" and call["region"] is None
    assert [r["segment_id"] for r in S.explode_turns(ok).orderBy("turn_index").collect()] == [
        "A_SEG_000", "A_SEG_001"]
    assert S.scan_transcripts(spark, str(tmp_path), limit=2).count() == 2


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("A", 1, "x"), ("B", 1, "x")], "id string, ts int, v string")
    new = spark.createDataFrame([("A", 2, "y"), ("C", 1, "z")], "id string, ts int, v string")
    once = S.latest_by_key(old, new, ["id"], [F.desc("ts"), "v"])
    twice = S.latest_by_key(once, new, ["id"], [F.desc("ts"), "v"])
    want = [("A", 2, "y"), ("B", 1, "x"), ("C", 1, "z")]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == want


def test_save_table(spark, tmp_path):
    rows = spark.createDataFrame([("A", "m"), ("B", "n"), ("C", "m")], "id string, part string")
    S.save_table(rows, str(tmp_path / "t"), ["part"])
    assert sorted(p.name for p in (tmp_path / "t").glob("part=*")) == ["part=m", "part=n"]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_turns_of_one_number_are_nested_by_a_flat_order(spark, turns):
    """A struct inside the sorted one, or a comparing lambda, made long calls of equal numbers slow."""
    rows = turns({"A": [("agent", f"text {i % 7}") for i in range(30)]}).withColumn(
        "turn_index", (F.col("turn_index") % 3).cast("int"))
    nested = S.nest_turns(rows)
    plan = nested._jdf.queryExecution().analyzed().toString()
    assert "sort_array" in plan and "array_sort" not in plan
    assert "struct(turn_index, turn_index" in plan and "struct(speaker, speaker" not in plan.split("collect_list")[1].split(" AS l#")[0]
    got = [(t["speaker"], t["text"], t["start_time"], t["end_time"], t["duration"])
           for t in nested.collect()[0]["transcript"]]
    want = sorted(rows.collect(), key=lambda r: (r["turn_index"], r["speaker"], r["text"], r["start_time"]))
    assert got == [(r["speaker"], r["text"], r["start_time"], r["end_time"], 5.0) for r in want]
