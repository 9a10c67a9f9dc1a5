"""Physical-plan properties the scale design relies on."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from ledgerloom.functions.columns import asc_last
from ledgerloom.operators import mart
from ledgerloom.operators.dedupe import first_wins
from ledgerloom.plans import fixtures, registry
from ledgerloom.plans.warehouse_run import warehouse

SF = "/root/testdata/sf0.001"
# Queries that run a stream or write files when called; their plans are
# covered by the queries they share operators with.
registry.load_all()
OWN = registry.QUERIES
SIDE_EFFECTS = {"streaming_incremental_load", "streaming_order_details", "streaming_mart_snapshot",
                "typed_tables", "temp_table_closings", "src_csv_latin1", "src_csv_utf8",
                "sink_csv_roundtrip", "stage_replace", "stage_append"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(OWN) - SIDE_EFFECTS))
def test_no_cartesian_product(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in p, name


def test_first_wins_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "id as v")
    p = plan(first_wins(df, ["k"]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_delta_split_reaches_the_orders_scan(spark):
    p = plan(fixtures.raw_orders(spark, SF))
    assert "LessThan(o_orderdate,2000-01-01T00:00)" in p


def test_point_in_time_join_is_keyed_by_customer_and_year(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = warehouse(spark, SF).final()
        p = plan(mart.orders_with_geography(s.orders, s.addresses))
        smj = [line for line in p.splitlines() if "SortMergeJoin" in line]
        assert smj and "customer_id" in smj[0] and "_year" in smj[0]
        assert "BroadcastNestedLoopJoin LeftOuter" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dense_keys_range_partition_without_single_partition_sort(spark):
    from ledgerloom.operators.keys import assign_dense_keys
    df = spark.range(100).selectExpr("cast(id as string) as k")
    p = plan(assign_dense_keys(df, "id", asc_last("k")))
    # the only single-partition work is the offsets window over one row per partition
    assert "SinglePartition" in p
    assert p.count("Exchange SinglePartition") == 1
