"""Trigrams are cut once per turn, however many turns it meets."""

import os

import pytest
from pyspark.sql import functions as F

from parley.catalog import REGISTRY
from parley.functions import text as X
from tests.oracle import compare, connect
from tests.test_shared_ids import SF, shared  # noqa: F401


def test_sets_of_trigrams(spark):
    texts = ["aaaa", "abcabc", "", "ab", None, "é€😀é€😀x", "Zz" * 40]
    rows = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    cut = rows.select("a", "b", X.trigram_codes(F.col("a")).alias("x"), X.trigram_codes(F.col("b")).alias("y"))
    got = cut.select("a", "b", "x", X.trigram_jaccard(F.col("a"), F.col("b")).alias("whole"),
                     X.trigram_jaccard(F.col("x"), F.col("y"), cut=True).alias("cut")).collect()
    for r in got:
        a, b = ({t[i:i + 3] for i in range(len(t) - 2)} for t in (r["a"] or "", r["b"] or ""))
        assert len(r["x"]) == len(a)
        assert r["whole"] == r["cut"] == (len(a & b) / len(a | b) if a and b else 0.0)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_turns_of_a_shared_id_are_cut_once(spark, shared, monkeypatch):  # noqa: F811
    """They were cut again for every turn that they met."""
    calls, cut = [], X.trigram_codes
    monkeypatch.setattr(X, "trigram_codes", lambda text: calls.append(str(text)) or cut(text))
    verdict, n, _, _, detail = compare(spark, connect(shared), "trigram_jaccard", REGISTRY["trigram_jaccard"], shared)
    assert verdict == "ok" and n > 0, detail
    plan = REGISTRY["trigram_jaccard"].run(spark, shared)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join Inner")[0], plan.split("Join Inner")[1]
    assert calls and "xxhash64" not in above and below.count("xxhash64") >= 2
