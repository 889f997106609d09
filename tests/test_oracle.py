"""Every registered query against its oracle on the smallest tables."""

from __future__ import annotations

import re

import pytest
from compare import differences, oracle

import __spark_entry__ as entry
from queryset import REGISTRY

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return oracle(sf)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(name, spark, sf, duck):
    frame = QUERIES[name](spark, sf)
    assert name in SQL
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # The only window without a partition key numbers the rows of one page.
    unpartitioned = [w for w in re.findall(r"Window \[[^\n]*", plan) if "windowspecdefinition(1" in w or re.search(r"windowspecdefinition\([a-z_]+#\d+L? (ASC|DESC)", w)]
    assert not unpartitioned or name in ("q1_search_page", "q1_search_deep_page", "q5_job_search")
    assert differences(frame, duck, SQL[name]) == []


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
