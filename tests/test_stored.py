"""Stored tables and what is kept up to date in them."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parley.operators import rollups as R
from parley.plans.workspace import new_path
from parley.sources.stored import StoredTable

SCHEMA = "k long, v string, at long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_once_per_batch(spark):
    table = StoredTable(spark, new_path(spark, "stored"), SCHEMA)
    assert rows(table.read()) == [] and table.parts() == {}
    newest, known = [F.desc("at"), F.desc("v")], {}
    for batch in range(3):
        new = [(k % 40, f"{batch}-{k}", batch) for k in range(batch * 7, batch * 7 + 30)] + [(None, "x", batch)] * 2
        df = spark.createDataFrame(new, SCHEMA)
        for _ in range(2):                                   # delivered twice
            table.upsert(df, ["k"], newest, f"b{batch}", parts=8)
        for k, v, at in sorted(new, key=lambda r: (r[2], r[1])):
            known[k] = (k, v, at)
        assert rows(table.read()) == sorted(known.values(), key=repr)
    before = table.parts()
    table.upsert(spark.createDataFrame([(1, "late", -1)], SCHEMA), ["k"], newest, "old", parts=8)
    assert sum(before[p] != q for p, q in table.parts().items()) == 1          # one part is rewritten
    assert rows(table.read()) == sorted(known.values(), key=repr)
    table.upsert(spark.createDataFrame([], SCHEMA), ["k"], newest, "none", parts=8)
    assert table.has("none") and rows(table.read()) == sorted(known.values(), key=repr)


def test_a_job_that_dies_before_its_commit_changes_nothing(spark, monkeypatch):
    table = StoredTable(spark, new_path(spark, "stored"), SCHEMA)
    table.upsert(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA), ["k"], [F.desc("at")], "first")
    df = spark.createDataFrame([(1, "c", 2), (3, "d", 2)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(StoredTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            table.upsert(df, ["k"], [F.desc("at")], "second")
    assert rows(table.read()) == [(1, "a", 1), (2, "b", 1)]
    table.upsert(df, ["k"], [F.desc("at")], "second")
    assert rows(table.read()) == [(1, "c", 2), (2, "b", 1), (3, "d", 2)]


def test_replaced_part_may_be_empty(spark):
    table = StoredTable(spark, new_path(spark, "stored"), SCHEMA)
    part = F.col("at").cast("string")
    table.replace(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), part, "one", ["1", "2"])
    table.replace(spark.createDataFrame([], SCHEMA), part, "two", ["2"])
    assert rows(table.read()) == [(1, "a", 1)] and rows(table.read(["2"])) == []
    for _ in range(2):
        table.append(spark.createDataFrame([(5, "e", 5)], SCHEMA), "three")
    assert rows(table.read()) == [(1, "a", 1), (5, "e", 5)]


def facts(spark, calls):
    return spark.createDataFrame([(i, *c) for i, c in calls.items()], R.FACT)


def recount(calls):
    groups = {}
    for ts, *dims, micros in calls.values():
        groups.setdefault(tuple(dims), []).append((ts, micros))
    out = []
    for dims, own in groups.items():
        known = [ts for ts, _ in own if ts]
        scored = [m for _, m in own if m is not None]
        out.append((*dims, len(own), len(scored), sum(scored), min(known, default=None), max(known, default=None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digits", [R.DAY, R.MONTH])
def test_rollup_equals_recount_after_random_changes(spark, monkeypatch, digits):
    rng = random.Random(4)

    def call():
        ts = rng.choice([None, datetime(2024, 1, 1) + timedelta(hours=rng.randrange(240), seconds=rng.randrange(60))])
        scored = rng.random() < .7
        return (ts, ts.strftime("%Y-%m-%d") if ts else R.NO_DAY, rng.choice(["loan", None]), "west", None,
                rng.choice(["complaint", "inquiry"]) if scored else None, "neutral" if scored else None,
                rng.choice(["high", "low"]) if scored else None, rng.random() < .5 if scored else None,
                rng.randrange(10 ** 6) if scored else None)
    kept, calls = R.CallRollup(spark, new_path(spark, "rollup"), digits), {}
    for batch in range(4):
        changed = {f"c{rng.randrange(60)}": call() for _ in range(25)}
        calls |= changed
        if batch == 2:                                       # dies between its two commits
            with monkeypatch.context() as m:
                m.setattr(kept.facts, "replace", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
                with pytest.raises(RuntimeError):
                    kept.update(facts(spark, changed), f"b{batch}")
        for _ in range(1 + (batch == 1)):                    # delivered twice
            kept.update(facts(spark, changed), f"b{batch}")
        assert rows(kept.cube()) == recount(calls)
        assert rows(kept.facts.read()) == sorted(((i, *c) for i, c in calls.items()), key=repr)
    # one day's change rewrites that day only
    day = datetime(2024, 1, 3, 12)
    calls["c0"] = (day, "2024-01-03", *calls["c0"][2:])
    kept.update(facts(spark, {"c0": calls["c0"]}), "settle")
    before = kept.days.parts()
    calls["c0"] = (day + timedelta(seconds=5), "2024-01-03", *calls["c0"][2:])
    kept.update(facts(spark, {"c0": calls["c0"]}), "same day")
    assert {d for d, p in kept.days.parts().items() if before.get(d) != p} == {"2024-01-03"[:digits]}
    assert rows(kept.cube()) == recount(calls)
    assert rows(kept.cube("2024-01-03", "2024-01-04")) == recount(
        {i: c for i, c in calls.items() if c[1] in ("2024-01-03", "2024-01-04")})


def test_ingest_is_replayable_and_keeps_rejects(spark, tmp_path, monkeypatch):
    import json

    from parley.sources.transcripts import SCHEMA as DOCUMENT
    from parley.streaming.streams import IngestTables

    def doc(call, product, at, texts, first=0):
        return {"call_id": call, "first_turn": first, "metadata": {"call_id": call, "product": product}, "ingestion_timestamp": at,
                "transcript": [{"speaker": "agent", "text": x, "start_time": 0.0, "end_time": 1.0} for x in texts]}
    one = [doc("a", "loan", "2024-01-02T00:00:00", ["x", "y"]), doc("b", "etf", None, ["z"]), {"call_id": "c"}, "{broken",
           {"transcript": []}, doc("d", "loan", None, [])]
    two = [doc("a", "card", "2024-01-01T00:00:00", ["old"]), doc("b", "card", None, ["z2", "z3"])]

    def batch(n, docs):
        path = tmp_path / f"{n}.json"
        path.write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))
        return spark.read.schema(DOCUMENT).option("columnNameOfCorruptRecord", "_corrupt_record").json(str(path))
    tables = IngestTables(spark, str(tmp_path / "tables"))
    with monkeypatch.context() as m:                         # dies after the rejects
        m.setattr(tables.turns, "upsert", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            tables.take(batch(0, one), 0)
    for n, docs in ((0, one), (0, one), (1, two), (1, two)):
        tables.take(batch(n, docs), n)
    assert rows(tables.calls.read().select("call_id", "product")) == [("a", "loan"), ("b", "card")]
    assert rows(tables.turns.read().select("call_id", "turn_index", "text")) == [
        ("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z2"), ("b", 1, "z3")]
    assert rows(tables.rejects.read().select("call_id", "reason")) == sorted(
        [("c", "no metadata"), (None, "unreadable"), (None, "no call id"), ("d", "no turns")], key=repr)


def test_model_calls_resume(spark, tmp_path, monkeypatch):
    from parley.operators import enrichment as N

    log = tmp_path / "asked"
    log.mkdir()

    def complete(texts, models, limits):
        import uuid
        if "bad" in texts:
            raise ValueError("no")
        for x in texts:
            (log / uuid.uuid4().hex).write_text(x)
        return [x.upper() for x in texts]

    def asked():
        return sorted(f.read_text() for f in log.iterdir())
    data = [(f"c{i}", 0, "gpt-4", "summary", f"prompt {i % 5}", 100) for i in range(10)] + [("c9", 0, "gpt-3.5", "summary", "bad", 5)]
    prompts = spark.createDataFrame(data, "call_id string, part long, model string, task string, prompt string, max_tokens long")
    answers = StoredTable(spark, new_path(spark, "answers"), N.ANSWER)
    with monkeypatch.context() as m:                         # dies after its first lot
        real, seen = StoredTable.append, []
        m.setattr(StoredTable, "append", lambda self, rows, batch: real(self, rows, batch) if not seen.append(1) and len(seen) < 2
                  else (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            N.resume_model(prompts, complete, answers, 2)
    got = N.resume_model(prompts, complete, answers, 2)
    assert {(r.prompt, r.output) for r in got.collect()} == {(f"prompt {i}", f"PROMPT {i}") for i in range(5)} | {("bad", None)}
    assert got.count() == 11
    N.resume_model(prompts, complete, answers, 2)
    assert asked() == [f"prompt {i}" for i in range(5)]       # each was paid for once
    assert answers.read().count() == 5 == answers.read().select("key").distinct().count()
