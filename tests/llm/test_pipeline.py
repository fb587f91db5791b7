"""The pipeline's stages after each other, against brute force, and the registered SQL."""

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from parley.catalog.base import Entry
from parley.llm.queries import QUERIES, SQL
from parley.plans.workspace import written
from tests.llm.test_documents import AZ, counted, roots, shingled
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_names():
    assert {f"op{n}_" for n in range(1, 14)} == {q[:q.index("_") + 1] for q in QUERIES if q != "pipeline"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    verdict, n, _, _, detail = compare(spark, connect(SF), name, Entry(QUERIES[name], SQL[name]), SF)
    assert verdict == "ok" and n > 0, detail


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        if name == "packing":
            break
        assert docs.columns == columns
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "quality rules":
            c = {i: counted(t) for i, t in kept.items()}
            good = {i: t for i, t in kept.items() if c[i][0] >= 50 and 100 * c[i][4] <= 50 * c[i][0]}
            assert set(rows) <= set(good.items()) and len(rows) > .9 * len(good)
            kept = dict(rows)
        if name == "line dedup":
            first = {}
            for i in sorted(kept):
                for x in kept[i].split("\n"):
                    first.setdefault(x.strip(" \t\n\x0b\f\r").translate(AZ), i)
            want = {i: "\n".join(x for x in t.split("\n") if len(k := x.strip(" \t\n\x0b\f\r").translate(AZ)) < 10
                                 or first[k] == i) for i, t in kept.items()}
            assert dict(rows) == want
            kept = want
        if name == "near-dedup":
            sets = {i: shingled(t) for i, t in kept.items()}
            group = roots(sorted(kept), [(a, b) for a in kept for b in kept if a < b
                                         and len(sets[a] & sets[b]) >= .8 * len(sets[a] | sets[b])])
            kept = {i: t for i, t in kept.items() if group[i] == i}
            assert dict(rows) == kept and len(rows) == len(kept)
        if name == "mixing":
            taken = Counter(i for i, _ in rows)
            assert set(rows) <= set(kept.items()) and max(taken.values()) <= 2
            words = sum(len(t.split()) for _, t in rows)
            assert abs(words - 1.5 * sum(len(t.split()) for t in kept.values())) < .1 * words
            kept = taken
    pieces = docs.collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == kept
    run = corpus_pipeline.run(spark, SF).drop("sequence_id", "offset")
    own = Counter(tuple(r[c] for c in run.columns) for r in pieces)
    assert own == Counter(map(tuple, run.collect()))


def test_the_rest_works_without_the_subpackage(tmp_path):
    """Entry points import where neither the subpackage nor the pipeline is there."""
    root = Path(__file__).resolve().parents[2]
    code = f"""
import importlib.abc, sys
sys.path.insert(0, {str(root)!r})
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if name == "corpus_pipeline" or name.startswith("parley.llm"):
            raise ModuleNotFoundError(name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 150 and not any(q.startswith("op1_") for q in e.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, timeout=120)
