"""Order keys from 1,000,000 on: ten calls share each id of six digits."""

import os

import pytest
from pyspark.sql import functions as F

from parley.catalog import REGISTRY
from parley.sources import transcripts as S
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    """The smallest tables with 200 orders of 20 ids."""
    folder = tmp_path_factory.mktemp("shared")
    for name in os.listdir(SF):
        os.symlink(f"{SF}/{name}", folder / name)
    con = connect(SF)
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        os.unlink(folder / f"{name}.parquet")
        con.execute(f"""COPY (SELECT * REPLACE ({key} + 1000000 AS {key}) FROM {name} WHERE {key} < 200)
                        TO '{folder}/{name}.parquet' (FORMAT parquet)""")
    return str(folder)


def matches_sql(spark, shared, name):
    verdict, n, _, _, detail = compare(spark, connect(shared), name, REGISTRY[name], shared)
    assert verdict == "ok" and n > 0, detail


def test_each_call_is_delivered_with_its_turns(spark, shared, monkeypatch):
    """Joined by id alone, the turns of ten calls came once per call and label of the ten: a hundred times."""
    turns, write = [], S.write_documents
    monkeypatch.setattr(S, "write_documents", lambda docs, path: (
        write(docs, path), turns.append(docs.agg(F.sum(F.size("transcript"))).first()[0])))
    got = REGISTRY["stream_upsert_calls"].run(spark, shared).toPandas()
    con = connect(shared)
    own, lent = con.execute("""SELECT (SELECT count(*) FROM lineitem), count(*) FROM orders JOIN lineitem ON o_orderkey // 10 = l_orderkey // 10
                               WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""").fetchone()
    assert turns == [3 * (own + lent)] and lent < own
    sql = con.execute(REGISTRY["stream_upsert_calls"].sql).df()
    assert got["call_id"].is_unique and len(got.merge(sql, on=list(got.columns))) == len(got)
    assert dict(zip(got["call_id"], got["call_timestamp"])) == sql.groupby("call_id")["call_timestamp"].max().to_dict()


def test_equal_documents_are_written_once(spark, shared, monkeypatch):
    """Documents that differ in nothing were written as often as an id has the same label."""
    turns, write = [], S.write_documents
    monkeypatch.setattr(S, "write_documents", lambda docs, path: (
        write(docs, path), turns.append(docs.agg(F.sum(F.size("transcript"))).first()[0])))
    matches_sql(spark, shared, "scan_transcripts")
    pairs = connect(shared).execute("""SELECT count(*) FROM lineitem JOIN orders o ON l_orderkey // 10 = o.o_orderkey // 10
      JOIN (SELECT DISTINCT o_orderkey // 10 AS id, o_orderpriority IN ('1-URGENT', '2-HIGH') FROM orders) ON id = l_orderkey // 10""").fetchone()[0]
    assert turns == [pairs]


def test_each_turn_is_ingested_once(spark, shared):
    """Turns of a shared id came a hundred times, numbered anew."""
    matches_sql(spark, shared, "stream_ingest")


def test_rejects_of_an_id_count_once(spark, shared):
    """They were counted once per call and label of the id."""
    matches_sql(spark, shared, "stream_rejects")


def test_each_turn_is_triaged_once(spark, shared):
    """Turns came as alerts once per call of their id, and not at all without one."""
    matches_sql(spark, shared, "stream_triage")


def test_turns_are_written_once_for_all_calls_of_an_id(spark, shared):
    """They were written, and scored, once per call of the id."""
    from parley.catalog import streams as CS
    from parley.catalog.base import Inputs
    path, schema = CS._turn_files(Inputs(spark, shared))
    rows = spark.read.schema(schema).parquet(path)
    con = connect(shared)
    pairs = con.execute("SELECT count(*) FROM lineitem JOIN orders ON o_orderkey // 10 = l_orderkey // 10").fetchone()[0]
    assert rows.count() == con.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    assert rows.agg(F.sum(F.size("event_time"))).first()[0] == pairs


def test_late_turns_of_a_shared_id(spark, shared):
    """Turns came once per call of the id and were compared with their number, so that some came less than not late."""
    got = {tuple(r) for r in REGISTRY["stream_late_turns"].run(spark, shared).collect()}
    want = connect(shared).execute(REGISTRY["stream_late_turns"].sql).fetchall()
    assert want and set(want) <= got and all(late >= 0 for *_, late in got)


def test_the_newest_delivery_meets_the_calls(spark, shared):
    """Every delivered line met every call of its id before the newest one was chosen."""
    got = REGISTRY["upsert_calls"].run(spark, shared)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "Join Inner" in line and "call_id" in line]
    below = plan.split(lines[0])[1]
    assert len(lines) == 1 and "Window" in below.split("Join Inner")[0]
    rows = got.drop("product").collect()
    want = connect(shared).execute("SELECT * EXCLUDE (product) FROM (" + REGISTRY["upsert_calls"].sql + ")").fetchall()
    assert sorted(map(tuple, rows)) == sorted(want)


def test_documents_are_put_together_once(spark, shared, monkeypatch):
    """They were once for each of their three deliveries."""
    plans, write = [], S.write_documents
    monkeypatch.setattr(S, "write_documents", lambda docs, path: (
        write(docs, path), plans.append(docs._jdf.queryExecution().optimizedPlan().toString())))
    assert REGISTRY["stream_rejects"].run(spark, shared).collect()
    assert [plan.count("collect_list") for plan in plans] == [1]
