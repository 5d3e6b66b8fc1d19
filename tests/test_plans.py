"""Plan properties the scale design relies on, checked on the real queries."""
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    skip = {"run_load", "stream_upsert", "cached_schema", "dependency_levels", "dependency_levels_dag",
            "target_columns", "empty_load", "drift_append"}  # they write
    return {n: plan(q(spark, SF)) for n, q in E.queries().items() if n in E.QUERIES and n not in skip}


def test_no_cartesian_or_nested_loop_or_python(plans):
    for name, p in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                    "ArrowEvalPython"):
            assert bad not in p, (name, bad)


def test_watermark_filter_reaches_the_scan(plans):
    p = plans["incremental_scan"]
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def test_key_side_reads_only_the_key(plans):
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plans["upsert_delete_insert"]


def test_top_n_and_dedup_reduce_before_the_shuffle(plans):
    assert "WindowGroupLimit" in plans["recent_runs"] and "Partial" in plans["recent_runs"]
    for name in ("dedup_last_wins", "upsert_last_wins"):
        assert "WindowGroupLimit" in plans[name], name
    assert plans["dedup_last_wins"].count("FileScan") == 1


def test_global_aggregates_combine_partially(plans):
    for name in ("platform_stats", "load_rows", "cast_report", "key_bounds"):
        assert "partial_" in plans[name], name


def test_layer_keys_carry_no_broadcast_hint(spark, tmp):
    from tidemark.plans.tables import VersionedTable
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    vt.write(spark.range(100).selectExpr("id", "'a' AS v"), 0)
    vt.write_layer(spark.range(3).selectExpr("id", "'b' AS v"), 1, "id")
    assert "strategy=broadcast" not in vt.read()._jdf.queryExecution().optimizedPlan().toString().lower()
