"""Plan tests: native execution (no Python evaluation), pruned scans,
broadcast only for the size-checked lists, skew-safe top-k and dedupe."""

from riskfeed.plans import queries as Qs
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_plan_is_native(spark):
    p = plan(Qs.daily_mentions(spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_is_pruned(spark):
    p = Qs.url_authority(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p


def test_block_list_broadcast(spark):
    assert "BroadcastHashJoin" in plan(Qs.blocked_source_gate(spark, SF_SMALL))


def test_top_k_uses_group_limit(spark):
    p = Qs.top_k_per_term(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p


def test_dedupe_combines_map_side(spark):
    p = plan(Qs.dedupe_keep_first(spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "SortAggregate" not in p


def test_no_python_anywhere(spark):
    for name in ("quality_score", "sentiment_compound", "risk_digest", "backfill_merge", "decode_terms"):
        p = plan(Qs.REGISTRY[name](spark, SF_SMALL))
        assert "EvalPython" not in p, name
