"""Search: both paths of the vector search, recall, edges of the keyword index."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.catalog import REGISTRY
from parley.operators import search as S
from parley.operators.postings import TextIndex
from parley.plans.workspace import new_path

SF = "/root/testdata/sf0.1"


@pytest.fixture
def vectors(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(300, 8))
    return m, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)],
                                    "id int, v array<double>")


def nearest(m, k):
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = np.floor(u @ u.T * 1e9 + 0.5) / 1e9
    return {(i, j) for i in range(len(m)) for j in
            sorted(range(len(m)), key=lambda j: (-s[i, j], j))[:k]}


def test_both_paths_are_exact(spark, vectors, monkeypatch):
    m, df = vectors
    q = df.select(F.col("id").alias("q"), F.col("v").alias("qv"))
    got = lambda: {(r["q"], r["id"]) for r in
                   S.vector_search(q, "q", "qv", df, "id", "v", 4).collect()}
    assert got() == nearest(m, 4)
    monkeypatch.setattr(S, "MAX_BROADCAST_QUERIES", 10)
    monkeypatch.setattr(S, "QUERY_BLOCK", 64)
    monkeypatch.setattr(S, "DOC_BLOCK", 90)
    assert got() == nearest(m, 4)


def test_ann_recall(spark, vectors):
    m, df = vectors
    q = df.select(F.col("id").alias("q"), F.col("v").alias("qv"))
    exact = nearest(m, 5)
    some = {(r["q"], r["id"]) for r in S.ann_search(
        q, "q", "qv", df, "id", "v", 5, lists=6, probes=3).collect()}
    assert len(some & exact) / len(exact) > 0.75
    everything = {(r["q"], r["id"]) for r in S.ann_search(
        q, "q", "qv", df, "id", "v", 5, lists=6, probes=6).collect()}
    assert everything == exact


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_recall_for_ordinary_rows(spark):
    """The query with its defaults asks every 50th vector and finds 0.9 of the nearest."""
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    q = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("qv"))
    exact = {(r["q"], r["vec_id"]) for r in S.vector_search(q, "q", "qv", vectors, "vec_id", "embedding").collect()}
    found = {(r["qid"], r["vec_id"]) for r in REGISTRY["ann_search"].run(spark, SF).collect()}
    assert {a for a, _ in found} == {a for a, _ in exact} and len(exact) == 10 * q.count()
    assert len(found & exact) >= .9 * len(exact)


def test_a_task_keeps_k_rows_per_query(spark, vectors, monkeypatch):
    """However many batches a task reads, and with scores held in small pieces."""
    m, df = vectors
    monkeypatch.setattr(S, "SCORE_ROWS", 16)
    monkeypatch.setattr(S, "SCORE_QUERIES", 7)
    monkeypatch.setattr(S, "rank_results", lambda found, *rest: found)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, 20)
    try:
        q = df.select(F.col("id").alias("q"), F.col("v").alias("qv"))
        found = [(r["q"], r["id"]) for r in
                 S.vector_search(q, "q", "qv", df.coalesce(1), "id", "v", 4).collect()]
    finally:
        spark.conf.set(batch, before)
    assert len(found) == 4 * len(m) and set(found) == nearest(m, 4)


def test_ann_reads_probed_lists_only(spark, vectors, monkeypatch):
    """One query probes one list: only that list's vectors are scored, in several blocks."""
    m, df = vectors
    monkeypatch.setattr(S, "DOC_BLOCK", 20)
    monkeypatch.setattr(S, "rank_results", lambda found, *rest: found)
    placed, centres = S.assign_lists(df, "id", "v", 6)
    sizes = {r["list"]: r["count"] for r in placed.groupBy("list").count().collect()}
    assert sum(sizes.values()) == len(m) and len(centres) == 6
    q = df.filter("id = 3").select(F.col("id").alias("q"), F.col("v").alias("qv"))
    home = placed.filter("did = 3").first()["list"]
    scored = S.ann_search(q, "q", "qv", df, "id", "v", len(m), lists=6, probes=1).collect()
    assert len(scored) == sizes[home] < len(m)


def test_edges_of_vectors(spark):
    """No queries, no documents, zero vectors, ties and texts without words."""
    d = spark.createDataFrame([(2, [0.0, 0.0]), (1, [0.0, 0.0]), (3, [2.0, 0.0])], "id int, v array<double>")
    q = spark.createDataFrame([("a", [1.0, 0.0])], "q string, qv array<double>")
    run = lambda f, x, y: [(r["q"], r["id"], r["score"]) for r in f(
        x, "q", "qv", y, "id", "v", 2).orderBy("rank").collect()]
    assert run(S.vector_search, q, d) == [("a", 3, 1.0), ("a", 1, 0.0)]
    for x, y in ((q.limit(0), d), (q, d.limit(0))):
        assert run(S.vector_search, x, y) == []
    assert run(S.ann_search, q.limit(0), d) == []
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "one one two")], "id int, t string")
    got = {r["id"]: r["embedding"] for r in S.embed_texts(texts, "t").collect()}
    assert got[1] == got[2] == [0.0] * len(got[3]) and sum(x * x for x in got[3]) == pytest.approx(1)


def test_keyword_index_edges(spark, monkeypatch):
    docs = spark.createDataFrame([
        (1, "card fee the fee"), (2, "card and loan"), (3, "the of and"), (4, "card pay the loan")],
        "id int, text string")
    index = S.tfidf_index(docs, "id", "text").collect()
    assert {r["id"] for r in index} == {1, 2, 4}
    assert {r["term"] for r in index if r["id"] == 1} == {"card", "fee", "card fee", "fee fee"}
    assert {r["term"] for r in index if r["id"] == 2} == {"card", "loan", "card loan"}
    for i in (1, 2, 4):
        assert sum(r["weight"] ** 2 for r in index if r["id"] == i) == pytest.approx(1.0)
    asked = spark.createDataFrame([("q", "loan"), ("none", "zebra")], "q string, t string")
    hits = lambda: [(r["q"], r["id"], r["score"]) for r in S.keyword_search(
        asked, "q", "t", docs, "id", "text").orderBy("rank").collect()]
    want = hits()
    assert [h[:2] for h in want] == [("q", 2), ("q", 4)]
    monkeypatch.setattr(S, "MAX_BROADCAST_QUERIES", 1)
    assert hits() == want


def test_merge_keeps_one_sided_results(spark):
    kw = spark.createDataFrame([("q", 1, 1.0), ("q", 2, 0.5)], "q string, d int, score double")
    sem = spark.createDataFrame([("q", 2, 0.5), ("q", 3, 0.5)], "q string, d int, score double")
    got = {r["d"]: r["score"] for r in S.merge_rankings(kw, sem, "q", "d").collect()}
    assert got == {1: 0.3, 2: 0.5, 3: 0.35}
    ranked = S.rank_results(S.merge_rankings(kw, sem, "q", "d"), ["q"], "score", "d", 2)
    assert [r["d"] for r in ranked.orderBy("rank").collect()] == [2, 3]


def test_shared_embeddings(spark):
    docs = spark.createDataFrame([(1, "a word"), (2, "a word"), (3, "other")], "id int, t string")
    direct, shared = ({r["id"]: r["embedding"] for r in S.embed_texts(
        docs, "t", reuse=reuse).collect()} for reuse in (False, True))
    assert direct == shared and direct[1] == direct[2] != direct[3]
    hook = S.embed_texts(docs, "t", embed=lambda c: F.array(F.length(c))).collect()
    assert {r["id"]: r["embedding"] for r in hook} == {1: [6], 2: [6], 3: [5]}
    reuse = S.embedding_reuse(docs, "t").collect()[0]
    assert (reuse["n_texts"], reuse["n_distinct"]) == (3, 2)


def test_stored_index(spark):
    """Batches add up, repeated ones don't count, and a search reads the asked buckets only."""
    import io
    from contextlib import redirect_stdout

    texts = [(i, " ".join(f"w{(i * k) % 13}" for k in range(1, 12)) + " card") for i in range(40)] + \
        [(40, None), (41, ""), (42, "lonely zebra"), (43, "card " * 50)]
    docs = spark.createDataFrame(texts, "id long, text string")
    asked = spark.createDataFrame([(1, "a lonely zebra"), (2, "w3 w4 card"), (3, "nothing known"), (4, None)], "q long, ask string")
    index = TextIndex(spark, new_path(spark, "index"), "bigint")
    index.add(docs.filter("id < 15"), "id", "text", "one")
    index.name_vocabulary("early")
    for _ in range(2):
        index.add(docs.filter("id >= 15"), "id", "text", "two")
    for _ in range(2):
        index.name_vocabulary("all")
    index.name_vocabulary("few", 5)
    for name, some, features in (("all", docs, 10_000), ("few", docs, 5)):
        want = S.keyword_search(asked, "q", "ask", some, "id", "text", 7, features)
        got = index.search(asked, "q", "ask", name, 7)
        assert sorted(map(tuple, got.select("q", "doc", "score", "rank").collect())) == \
            sorted(map(tuple, want.select("q", "id", "score", "rank").collect()))
    before = sorted(map(tuple, index.search(asked, "q", "ask", "all", 7).collect()))
    index.compact("together")
    index.add(docs.filter("id < 15"), "id", "text", "one")
    assert sorted(map(tuple, index.search(asked, "q", "ask", "all", 7).collect())) == before
    assert len(index.postings.parts()) == 1
    assert index.vocabulary("early").filter("term = 'zebra'").isEmpty()
    out = io.StringIO()
    with redirect_stdout(out):
        index.matching(spark.createDataFrame([("zebra",)], "term string")).explain("formatted")
    plan = out.getvalue()
    assert "In(term, [zebra])" in plan or "EqualTo(term,zebra)" in plan
    assert any("PartitionFilters" in line and "bucket" in line for line in plan.splitlines())
    used = {f.split("bucket=")[1].split("/")[0] for f in index.matching(
        spark.createDataFrame([("zebra",)], "term string")).select("_metadata.file_path").distinct().toPandas().file_path}
    assert len(used) == 1


def test_equal_documents_are_scored_once(spark, monkeypatch):
    """Hybrid results over documents with copies equal those of scoring every document; texts are scored once."""
    words = ["refund card fee", "card error fee", "loan rate", "fee card refund", "refund card fee | Summary: loan"]
    rows = [(f"S{i:03}", words[i * 7 % 5]) for i in range(60)] + [("T1", "refund"), ("T2", "loan fee loan")]
    docs = spark.createDataFrame(rows, "segment_id string, document string")
    asked = S.embed_texts(spark.createDataFrame(
        [("a", "refund of a card fee"), ("b", "loan"), ("c", "nothing known")],
        "query_id string, query_text string"), "query_text", "query_vec")
    every = S.hybrid_search(asked, "query_id", "query_text", "query_vec", S.embed_texts(docs, "document"),
                            "segment_id", "document", "embedding", 4)
    scored = []
    whole = S.vector_search
    monkeypatch.setattr(S, "vector_search", lambda *a: scored.append(a[3].count()) or whole(*a))
    once = S.hybrid_text_search(asked, "query_id", "query_text", "query_vec", docs, "segment_id", "document",
                                S.embed_texts, 4)
    rows = lambda df: sorted(tuple(r) for r in df.select("query_id", "segment_id", "keyword_score",
                                                         "semantic_score", "score", "rank").collect())
    assert rows(once) == rows(every)
    assert scored == [7]


def test_copies_of_a_segment_rank_as_rows(spark):
    """A segment that comes twice, as under ids of two calls, takes two places; its other texts stay apart."""
    docs = spark.createDataFrame([("S1", "refund card"), ("S1", "refund card"), ("S1", "loan rate"), ("S2", "refund fee")],
                                 "segment_id string, document string")
    asked = S.embed_texts(spark.createDataFrame([("a", "refund card")], "query_id string, query_text string"),
                          "query_text", "query_vec")
    got = S.hybrid_text_search(asked, "query_id", "query_text", "query_vec", docs, "segment_id", "document",
                               S.embed_texts, 1).collect()
    assert [(r.segment_id, r.keyword_score, r.semantic_score) for r in got] == [("S1", 1.0, 1.0)]


def test_terms_are_counted_in_place(spark, monkeypatch):
    """Counting terms shuffles nothing; the index is the same however many tasks sort its rows."""
    rows = [(i, " ".join(f"word{(i * j) % 7} card" for j in range(i % 9))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    counts = S.term_counts(docs, "doc_id", "text")
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    index = lambda: sorted((r.doc_id, r.term, r.tf, round(r.weight, 9)) for r in S.tfidf_index(docs, "doc_id", "text").collect())
    whole = index()
    assert sum(r[2] for r in whole if r[1] == "card") == sum(t.split().count("card") for _, t in rows)
    monkeypatch.setattr(S, "PART_ROWS", 2)
    assert index() == whole


def test_turns_of_a_shared_id_are_one_document(spark):
    """Turns of calls that share an id are scored as one text, as the SQL groups them."""
    from parley.operators import summaries as M
    rows = spark.createDataFrame([("C1", 0, "refund card"), ("C1", 0, "loan rate"), ("C2", 0, "refund card")],
                                 "call_id string, turn_index int, text string")
    got = {(r.call_id, r.turn_index): r.score for r in M.query_focused_turns(rows, "refund card").collect()}
    assert set(got) == {("C1", 0), ("C2", 0)} and got["C2", 0] == 1.0 and 0 < got["C1", 0] < 1


def test_a_text_is_cut_into_terms_once(spark):
    """A filter on the number of terms cut every text a second time."""
    docs = spark.createDataFrame([(1, "loan fee loan"), (2, "the"), (3, None), (4, "")], "id int, text string")
    counts = S.exploded_counts(docs, "text", False, "id")
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert sorted(map(tuple, counts.collect())) == [(1, "fee", 1), (1, "loan", 2)]
