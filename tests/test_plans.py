"""Plan checks: built-in expressions only, no pair-producing joins, pushdown and group limits."""

import pytest

from conftest import SF_SMALL
from listingflow.plans.registry import QUERIES
from listingflow.sources.fixtures import raw_listings

FORBIDDEN_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                   "BroadcastNestedLoopJoin")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES
                                        if n not in ("scd2_incremental", "ingest_stream", "ingest_bad_lines")))
def test_no_python_udf_or_cartesian(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    for node in FORBIDDEN_NODES:
        assert node not in plan, f"{name}: {node}"


def test_mark_filter_reaches_parquet_scan(spark):
    plan = physical(QUERIES["incremental_read"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan(l_shipdate" in plan


def test_dedup_has_partial_group_limit(spark):
    from listingflow.operators.merge import dedup_latest
    df = dedup_latest(raw_listings(spark, SF_SMALL), "Property_ID",
                      ["bronze_ingested_at", "row_seq"])
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_means_are_broadcast_not_windowed(spark):
    from listingflow.plans.silver import silver_transform
    plan = physical(silver_transform(raw_listings(spark, SF_SMALL), "2021-06-30"))
    assert "BroadcastHashJoin" in plan
    assert "Window [avg" not in plan and "SortMergeJoin" not in plan


def test_scan_prunes_columns(spark):
    df = QUERIES["chat_context"](spark, SF_SMALL)
    plan = physical(df)
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,role:string,text:string>" in plan
