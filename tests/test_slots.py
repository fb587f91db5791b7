"""Vectors of slots go between Spark and numpy as they are."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.functions import vectors as V


@pytest.mark.parametrize("at_once", [3, 1 << 20])
def test_vectors_of_slots(monkeypatch, at_once):
    monkeypatch.setattr(V, "COUNTED_SLOTS", at_once)
    lists = [[1, 1, 2], [], None, [0], [3, 3, 3, 3, 3, 3, 3], [2, 1, 0, 3], []]
    want = []
    for x in lists:
        v = np.bincount(x or [], minlength=4).astype(float)
        want.append((v / (np.sqrt((v * v).sum()) or 1.0)).tolist())
    some = pa.array([[9], *lists, [9]], pa.list_(pa.int32())).slice(1, len(lists))
    assert V.slot_lists(some, 4).to_pylist() == want
    assert [list(v) for v in V.slot_vectors(pd.Series([x if x is None else np.array(x, "int32") for x in lists]), 4)] == want
    assert V.slot_lists(some.slice(0, 0), 4).to_pylist() == []


def test_embedding(spark, monkeypatch):
    """Vectors were handed over as one Python object each."""
    df = spark.createDataFrame([("one two two",), ("",), (None,)], "text string")
    out = df.select(V.hashed_embedding(F.col("text")).alias("v"))
    monkeypatch.setattr(V, "slot_vectors", None)
    rows = [r["v"] for r in out.collect()]
    assert [sum(x * x for x in v) for v in rows] == [pytest.approx(1.0), 0.0, 0.0] and all(len(v) == 64 for v in rows)
