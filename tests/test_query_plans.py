"""Shape of the physical plans: no pairing joins, and pruning reaches the scan."""

from __future__ import annotations

import re

import pytest

from tidewater import registry

FOLDER = "/root/testdata/sf0.001"
PLANNED = [n for n in sorted(registry.queries()) if n.startswith(("q0", "q1", "q2", "ag", "dq0", "ds", "fn", "hx", "jn", "or", "pj", "st", "wn"))]


def plan_of(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString("simple"))


@pytest.mark.parametrize("name", PLANNED)
def test_no_pairing_joins(spark, name):
    plan = plan_of(registry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name,pushed", [
    ("pj05_between_inclusive", "GreaterThanOrEqual(p_size,5)"), ("pj06_half_open_days", "LessThan(o_orderdate"),
    ("pj07_in_list", "In(c_mktsegment"), ("q12_revenue_per_local_day_and_class", "GreaterThanOrEqual(l_shipdate"),
    ("or03_top_k_with_ties", "ScalarSubquery")])
def test_filters_are_pushed(spark, name, pushed):
    plan = plan_of(registry.queries()[name](spark, FOLDER))
    assert any(pushed in line for line in re.findall(r"PushedFilters: \[.*?\], ReadSchema", plan))


def test_columns_are_pruned(spark):
    plan = plan_of(registry.queries()["ag14_mode"](spark, FOLDER))
    assert "ReadSchema: struct<l_quantity:double>" in plan
