"""Physical-plan properties: no Python in the plans, pushdown, pruning, partial aggregation."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_python_and_no_pair_joins_in_plans(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert not any(n in p for n in PYTHON_NODES), p
    assert not any(n in p for n in PAIR_NODES), p


def test_partition_pruning(spark):
    p = plan(entry.queries()["partitioned_roundtrip"](spark, SF))
    assert "PartitionFilters: [isnotnull(o_orderdate_year" in p and "= 1998" in p


def test_daily_slice_pushed_to_scan(spark):
    p = plan(entry.queries()["daily_slice"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_flagship_prunes_and_aggregates_before_the_join(spark):
    df = entry.entry(spark)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in p
    assert "ReadSchema: struct<p_partkey:bigint>" in p
    assert p.count("partial_count(1)") == 2  # fact and dimension both pre-aggregated
    assert "EqualTo(event_type,view)" in p


def test_top_with_ties_uses_no_window_over_years(spark):
    p = plan(entry.queries()["most_used_platform_by_year"](spark, SF))
    assert "Window" not in p
