"""Side-by-side run of a registered query and its SQL text."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SAME = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(pdf):
    names = sorted(pdf.columns)
    cells = []
    for n in names:
        col = pdf[n]
        if pd.api.types.is_datetime64_any_dtype(col):
            col = col.astype(str)
        cells.append([None if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v)
                      else (0.0 if isinstance(v, float) and v == 0 else v) for v in col.tolist()])
    return sorted(zip(*cells), key=repr) if cells else []


def compare(spark, con, name, entry, sf_dir):
    """(verdict, rows, spark seconds, sql seconds, detail)"""
    t0 = time.time()
    df = entry.run(spark, sf_dir)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    got = df.toPandas()
    t1 = time.time()
    if entry.sql is None:
        return "rows-only", len(got), t1 - t0, 0.0, ""
    cur = con.execute(entry.sql)
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchdf()
    t2 = time.time()
    detail = ""
    if sorted(types) != sorted(want_types):
        detail = f"columns {sorted(types)} / {sorted(want_types)}"
    else:
        off = {c: (t, want_types[c]) for c, t in types.items() if SAME.get(t) != want_types[c]}
        a, b = rows_of(got), rows_of(want)
        if len(a) != len(b):
            detail = f"rows {len(a)} / {len(b)}"
        elif a != b:
            i = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
            n = sum(x != y for x, y in zip(a, b))
            detail = f"{n} rows differ; spark {a[i]} / sql {b[i]} cols {sorted(types)}"
        elif off:
            detail = f"types {off}"
    return ("ok" if not detail else "MISMATCH"), len(got), t1 - t0, t2 - t1, detail


def main(sf_dir, only=()):
    from parley.catalog import REGISTRY
    from parley.plans.workspace import build_session
    spark = build_session("oracle", "8", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, entry in REGISTRY.items():
        if only and not any(o in name for o in only):
            continue
        try:
            verdict, n, ts, tq, detail = compare(spark, con, name, entry, sf_dir)
        except Exception as e:                                    # noqa: BLE001
            verdict, n, ts, tq, detail = "ERROR", -1, 0, 0, str(e)[:1500]
        bad += verdict in ("ERROR", "MISMATCH")
        print(f"{verdict:10} {name:32} {n:7} {ts:6.2f}s {tq:6.2f}s {detail[:1500]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
