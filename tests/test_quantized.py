"""Product-quantised codes: recall against brute force, both paths, edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.operators import quantized as Z
from parley.operators import search as S
from tests.test_search import nearest


def table(spark, m):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, v array<double>")


def asked(df):
    return df.select(F.col("id").alias("q"), F.col("v").alias("qv"))


def test_recall_without_clusters(spark, monkeypatch):
    """Directions without any structure, 13 numbers in 4 pieces; a quarter is compared in full."""
    m = np.random.default_rng(4).normal(size=(1200, 13))
    df, exact = table(spark, m), nearest(m, 5)
    index = Z.QuantizedIndex(df, "id", "v", parts=4, centres=64)
    assert index.codes.filter(F.length("dvec") != 4).isEmpty() and index.codes.count() == len(m)
    found = lambda n: {(r.q, r.id) for r in index.search(asked(df), "q", "qv", 5, rerank=n).collect()}
    some = found(150)
    assert len(some & exact) / len(exact) >= 0.9
    assert found(len(m)) == exact                       # all compared in full: nothing is lost
    monkeypatch.setattr(S, "MAX_BROADCAST_QUERIES", 10)
    monkeypatch.setattr(S, "QUERY_BLOCK", 500)
    monkeypatch.setattr(S, "DOC_BLOCK", 400)
    assert found(150) == some                           # in blocks


def test_a_third_of_all_vectors_is_one(spark):
    """Copies, a sample of few distinct pieces, every vector its own code: scores are exact, ties go by id."""
    m = np.random.default_rng(5).normal(size=(90, 8))
    m[::3] = m[0]
    df = table(spark, m)
    got = Z.QuantizedIndex(df, "id", "v").search(asked(df).filter("q < 3"), "q", "qv", 4).collect()
    assert {(r.q, r.id) for r in got} == {(q, i) for q, i in nearest(m, 4) if q < 3}
    assert [(r.id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.q == 0] == [(i, 1.0) for i in (0, 3, 6, 9)]


def test_fitting_on_a_sample_encodes_all(spark):
    m = np.random.default_rng(6).normal(size=(2000, 8))
    df = table(spark, m)
    one, other = (Z.QuantizedIndex(df, "id", "v", parts=2, centres=32, train_rows=300) for _ in range(2))
    assert all((a == b).all() and a.shape == (32, 4) for a, b in zip(one.books, other.books))
    assert one.codes.select("did").distinct().count() == len(m)


def test_edges(spark):
    d = spark.createDataFrame([(2, [0.0, 0.0], "x"), (1, [0.0, 0.0], "x"), (3, [2.0, 0.0], "x"), (4, None, "x"), (3, [2.0, 0.0], "x")],
                              "id int, v array<float>, q string")
    q = spark.createDataFrame([("a", [1.0, 0.0]), ("z", [0.0, 0.0]), ("n", None)], "qid string, qv array<double>")
    index = Z.QuantizedIndex(d, "id", "v")
    got = [(r.qid, r.id, r.score) for r in index.search(q, "qid", "qv", 5).orderBy("qid", "rank").collect()]
    assert {x for x in got if x[0] == "a"} == {("a", 3, 1.0), ("a", 1, 0.0), ("a", 2, 0.0)}
    assert {x[2] for x in got if x[0] == "z"} == {0.0} and not any(x[0] == "n" for x in got)
    assert index.search(q.limit(0), "qid", "qv").collect() == []
    assert Z.QuantizedIndex(d.limit(0), "id", "v").search(q, "qid", "qv").collect() == []
    with pytest.raises(ValueError):
        Z.QuantizedIndex(d, "id", "v", centres=300)
