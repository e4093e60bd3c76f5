"""What the plans must show: ranks limited before the shuffle, filters and columns at the scan, no Python where none is needed."""

from __future__ import annotations

from pathlib import Path

import pytest

from tessera.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not here")


def plan(spark, name):
    return QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


def test_ranks_are_limited_on_the_map_side(spark):
    assert "WindowGroupLimit" in plan(spark, "doi_dedup_best")


def test_filters_reach_the_scan(spark):
    text = plan(spark, "log_summary")
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "props" not in text.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("name", ["record_keys", "title_keys", "dedup_method_chain", "disambiguation", "failure_tags", "screening_stats", "log_windows", "boolean_search"])
def test_no_python(spark, name):
    assert not any(word in plan(spark, name) for word in ("Python", "Pandas", "InArrow"))
