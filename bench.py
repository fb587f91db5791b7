"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.  Every query is
run in full (all rows and columns are produced, none kept).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parley.catalog import REGISTRY  # noqa: E402
from parley.plans.workspace import build_session  # noqa: E402

HEADLINE = (
    "analyze_segments", "aggregate_segments", "importance_distribution", "analytics_summary",
    "query_calls", "top_complaints", "sentiment_trend", "call_volume_trend_daily",
    "related_calls", "previous_calls_30d", "evaluate_thresholds", "enrichment_queue",
    "speaker_runs", "remove_repetitions", "noise_filter", "noise_filter_full",
    "extractive_select", "turn_salience", "extractive_summary", "fixed_chunks_overlap",
    "tfidf_index", "keyword_search", "vector_search", "hybrid_search", "rrf_search",
    "classify_queries", "answer_analytics_questions", "render_prompts", "assemble_enrichment",
    "retrieve", "answer_table", "detect_pii", "redact_pii_pages", "language_report",
    "stream_triage", "stream_call_rollup", "stream_volume",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = build_session("bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["importance_distribution"].run(spark, sf_dir).collect()          # warm-up
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    n_turns = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    triage = times.get("aggregate_segments")
    print(json.dumps({
        "metric": "total wall time of headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"),
        "turns_triaged_per_second": round(n_turns / triage) if triage else None,
        "cpus": cpus, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
