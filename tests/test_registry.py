"""Registered queries against their SQL on the smallest tables.

All of them with PARLEY_ALL=1; by default one in each family.
"""

import os

import pytest

from parley.catalog import REGISTRY
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
DEFAULT = """analyze_segments aggregate_segments importance_distribution analytics_summary
query_calls related_calls previous_calls_30d evaluate_thresholds upsert_calls scan_transcripts
assemble_transcript remove_repetitions_lag speaker_runs extractive_select topic_label
noise_filter_full turn_salience_multi extractive_summary_tight rouge_2 hybrid_search rrf_search
assemble_enrichment answer_analytics_questions dedupe_queries answer_table metric_counters
alert_rules language_report stream_call_rollup stream_volume_sliding volume_spikes
calendar_spikes stream_spikes
language_ngrams latency_sketch_days distinct_users_weeks stream_operation_alerts stream_calls live_summaries
ann_quantized_recall""".split()
NAMES = [n for n, e in REGISTRY.items() if e.sql] if os.environ.get("PARLEY_ALL") else DEFAULT

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    verdict, n, _, _, detail = compare(spark, con, name, REGISTRY[name], SF)
    assert verdict == "ok" and n > 0, detail


def test_entry_points():
    import __spark_entry__ as driver
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.queries()) > 150
