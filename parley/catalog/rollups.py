"""Answers from maintained roll-ups, which take changed calls instead of reading all turns."""

from parley.catalog.base import query
from parley.catalog.calls import CATEGORY_QUERIES, _SENT, _summary_sql, triage_sql
from parley.catalog.sql_views import sql
from parley.operators import rollups as R
from parley.plans.workspace import new_path, written


def _rollup(t):
    """All calls as they arrive, without results, then again with the results of scoring."""
    kept = R.CallRollup(t.spark, new_path(t.spark, "rollup"))
    kept.update(R.call_facts(t.calls), "arrived")
    kept.update(written(R.call_facts(t.calls, t.pc), "facts"), "scored")
    return kept


@query(sql("""SELECT coalesce(strftime(call_timestamp, '%Y-%m-%d'), 'none') AS day, product, region, client_segment, overall_intent,
 overall_sentiment, overall_importance, requires_enrichment, count(*) AS n_calls, count(weighted_score) AS n_scored,
 coalesce(sum(round(weighted_score * 1000000)::BIGINT), 0)::BIGINT AS weighted_micros, min(call_timestamp) AS first_call,
 max(call_timestamp) AS last_call FROM all_calls GROUP BY ALL""", "all_calls"))
def rollup_update(t):
    """The maintained cube itself equals a full recount."""
    return _rollup(t).cube()


@query(sql(_summary_sql(), "all_calls"))
def rollup_summary(t):
    return R.summary_from(_rollup(t).cube())


@query(sql(_summary_sql("WHERE call_timestamp::DATE BETWEEN DATE '2000-01-01' AND DATE '2001-12-31'"), "all_calls"))
def rollup_summary_days(t):
    """Only the parts of two years' days are read."""
    return R.summary_from(_rollup(t).cube("2000-01-01", "2001-12-31"))


@query(sql(CATEGORY_QUERIES["intent"], "pc"))
def rollup_count_by_intent(t):
    return R.counts_from(_rollup(t).cube(), "intent")


@query(sql(f"""SELECT date_trunc('month', call_timestamp)::TIMESTAMP AS period, {_SENT}
FROM both_calls GROUP BY 1 ORDER BY 1 DESC LIMIT 30""", "both_calls"))
def rollup_sentiment_monthly(t):
    return R.sentiment_from(_rollup(t).cube(), "monthly")


@query(sql(triage_sql(), "pc"))
def rollup_triage_rate(t):
    return R.triage_from(_rollup(t).cube())
