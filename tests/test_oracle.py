"""Registered queries against their DuckDB oracle SQL (the driver's check),
on the smallest scale factor. RISKFEED_FULL_ORACLE=1 runs every key."""

import os

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

FAST = ["decode_terms", "normalize_item", "page_text", "page_text_backfill", "sentiment_compound",
        "url_gates", "new_links_only", "top_k_per_term", "attach_risk_ids", "quality_score",
        "score_component_stats", "risk_prompt", "dedupe_keep_first", "backfill_merge", "daily_mentions"]


def _keys():
    import __spark_entry__ as E
    keys = list(E.oracle_sql())
    return keys if os.environ.get("RISKFEED_FULL_ORACLE") else [k for k in keys if k in FAST]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _keys())
def test_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    ok, msg, _, _ = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert ok, msg


def test_every_query_has_oracle():
    import __spark_entry__ as E
    own = {k for k in E.queries() if k != "pipeline" and not k.startswith("op")}
    assert own == {k for k in E.oracle_sql() if k in own}
