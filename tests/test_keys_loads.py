"""Dense keys, first-wins, replay idempotency and the period correction."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions.columns import asc_last
from ledgerloom.operators import warehouse as wh
from ledgerloom.operators.dedupe import first_wins
from ledgerloom.operators.keys import assign_dense_keys
from tests.edge_frames import D, core, stage


def test_dense_keys_equal_global_rank(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 10007).alias("k"),
                                     (F.col("id") % 3).alias("g"))
    keyed = assign_dense_keys(df, "kid", asc_last("k"), start=100, partitions=7)
    rows = keyed.collect()
    by_k = sorted(rows, key=lambda r: r["k"])
    assert [r["kid"] for r in by_k] == list(range(101, 5101))


def test_dense_keys_start_from_frame_and_empty_input(spark):
    start = spark.createDataFrame([(41,)], "m long")
    df = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    got = {r["k"]: r["id"] for r in assign_dense_keys(df, "id", asc_last("k"), start).collect()}
    assert got == {"a": 42, "b": 43, None: 44}
    empty = spark.createDataFrame([], "k string")
    assert assign_dense_keys(empty, "id", asc_last("k")).count() == 0


def test_first_wins_is_deterministic_nulls_last(spark):
    df = spark.createDataFrame([("k", "b", None), ("k", "a", "z"), ("k", "a", None), ("j", None, "x")],
                               "key string, v1 string, v2 string")
    got = {r["key"]: (r["v1"], r["v2"]) for r in first_wins(df, ["key"]).collect()}
    assert got == {"k": ("a", "z"), "j": (None, "x")}


def _raw(spark):
    return stage(spark, [
        dict(row_key="1", order_id="ORD-10", customer_id="C1", product_id="P1",
             order_date="1999-01-01", ship_date="1998-12-30"),
        dict(row_key="2", order_id="ORD-10", customer_id="C1", product_id="P2",
             order_date="1999-01-01", ship_date="1999-01-03"),
        dict(row_key="3", order_id="ORD-20", customer_id="C2", product_id="P1",
             customer_name="Bo", order_date="1999-02-01", ship_date="1999-02-02"),
    ])


def test_initial_load_first_wins_on_ship_date(spark):
    state = wh.initial_load(_raw(spark))
    orders = {r["order_number"]: (r["order_id"], r["ship_date"]) for r in state.orders.collect()}
    assert orders == {"ORD-10": (1, D(1998, 12, 30)), "ORD-20": (2, D(1999, 2, 2))}
    assert state.order_details.count() == 3
    assert sorted(r["order_detail_id"] for r in state.order_details.collect()) == [1, 2, 3]


def test_replaying_a_batch_adds_nothing(spark):
    state = wh.initial_load(_raw(spark))
    delta = stage(spark, [
        dict(row_key="9", order_id="ORD-30", customer_id="C3", product_id="P3", quantity=0,
             order_date="2000-01-05", ship_date="2000-01-01", valid_from="2000-01-05",
             is_new_version=True),
        dict(row_key="1", order_id="ORD-10", customer_id="C1", product_id="P1",
             order_date="1999-01-01", ship_date="1998-12-30"),
    ])
    once = wh.secondary_load(state, delta)
    new_orders = {r["order_number"]: r for r in once.counters["orders"].collect()}
    assert set(new_orders) == {"ORD-30"}
    o = new_orders["ORD-30"]
    assert (o["order_id"], o["batch_id"], o["ship_date"]) == (3, 2, D(2000, 1, 5))
    (line,) = once.counters["details"].collect()
    assert (line["quantity"], line["order_detail_id"]) == (1, 4)
    twice = wh.secondary_load(once, delta)
    assert twice.counters["orders"].count() == 0
    assert twice.counters["details"].count() == 0
    assert twice.customers.count() == once.customers.count() == 3
    assert twice.products.count() == once.products.count() == 3


def test_correction_thins_prefix_lines_and_drops_orphans(spark):
    orders = core(spark, "orders", [
        dict(order_id=i, customer_id=1, order_number=n, order_date=d, ship_date=d,
             ship_mode="x", batch_id=2)
        for i, n, d in [(1, "ORD-1a", D(2000, 6, 1)), (2, "ORD-2", D(2000, 6, 2)),
                        (3, "ORD-3", D(2001, 1, 1)), (4, "ORD-1b", D(1999, 6, 1))]])
    details = core(spark, "order_details", [
        dict(order_detail_id=i, order_id=o, product_id=1, sales=Decimal("1.00"), quantity=1,
             discount=Decimal("0.00"), profit=Decimal("0.10"))
        for i, o in [(i, 1) for i in range(1, 41)] + [(100, 4), (101, 4)]])
    fix = wh.Correction(dt.date(2000, 1, 1), dt.date(2000, 12, 31), "ORD-1", 20)
    kept_orders, kept, doomed, orphans = wh.correct_period(orders, details, fix)
    # ORD-2 (in period, no lines, no prefix) is an orphan; ORD-3 is outside the period
    assert {r["order_id"] for r in orphans.collect()} == {2}
    assert {r["order_id"] for r in kept_orders.collect()} == {1, 3, 4}
    # lines outside the period are never thinned
    assert kept.filter("order_id = 4").count() == 2
    n_doomed = doomed.count()
    assert 0 < n_doomed < 40 and kept.count() == 42 - n_doomed


def test_delta_scd1_flags_against_every_loaded_value(spark):
    from ledgerloom.operators.delta import delta_scd1_rows
    loaded = stage(spark, [
        dict(row_key="l1", order_id="O1", product_id="P1", customer_name="Ann", segment=None),
        dict(row_key="l2", order_id="O1", product_id="P1", customer_name="Ann", segment="S"),
        dict(row_key="l3", order_id="O2", product_id="P1", customer_name="Bo", segment="S"),
    ])
    incoming = stage(spark, [
        dict(row_key="i1", order_id="O1", product_id="P1", customer_name="Ann", segment="S"),
        dict(row_key="i2", order_id="O2", product_id="P1", customer_name="Bo", segment="S"),
        dict(row_key="i3", order_id="O2", product_id="P1", customer_name="Bob", segment=None),
        dict(row_key="i4", order_id="O9", product_id="P1", customer_name="Zed"),
    ])
    got = {r["row_key"]: (r["name_changed"], r["segment_changed"], r["sales_changed"])
           for r in delta_scd1_rows(loaded, incoming).collect()}
    # i1 differs from the NULL segment of l1; i2 is identical; i4 has no loaded line
    assert got == {"i1": (False, True, False), "i3": (True, True, False)}
