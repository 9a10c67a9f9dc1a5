"""Parts are skipped only if they hold none of the batch's keys."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import delta, upkeep
from ledgerloom.operators import warehouse as wh
from ledgerloom.session import ensure_checkpoint_dir
from ledgerloom.sources import part_index
from ledgerloom.streaming.incremental import SnapshotLog
from tests.edge_frames import stage
from tests.test_upkeep import line


def index_of(spark, parts, rows=1000):
    out = None
    for name, keys in parts.items():
        part = spark.createDataFrame([(k,) for k in keys], "k long")
        own = part_index.index_part(part, name, ["k"], rows)
        out = own if out is None else out.union(own)
    return out.cache()


def asked(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k long")


def test_a_part_that_holds_a_key_is_never_skipped(spark):
    parts = {f"p{i}": [j for j in range(i, 3000, 7)] for i in range(7)}
    index = index_of(spark, parts)
    for keys in ([5], [12, 2999], [1, 8, 15], list(range(0, 3000, 100))):
        found = part_index.parts_with(index, asked(spark, keys), "k")
        assert {p for p, own in parts.items() if set(own) & set(keys)} <= set(found)


def test_foreign_keys_rarely_meet_a_part(spark):
    parts = {"even": list(range(0, 20_000, 2)), "three": list(range(1, 20_000, 6))}
    index = index_of(spark, parts, rows=10_000)
    assert index.select(F.max("bits")).first()[0] >= 10_000 * part_index.BITS_A_ROW
    wrong = sum("even" in part_index.parts_with(index, asked(spark, [k]), "k") for k in range(1, 99, 2))
    assert wrong <= 15


def test_bounds_and_nulls(spark):
    index = index_of(spark, {"a": [10, 20, None], "none": [None]})
    assert part_index.parts_with(index, asked(spark, [None]), "k") == []
    assert part_index.parts_with(index, asked(spark, []), "k") == []
    assert part_index.parts_with(index, asked(spark, [99]), "k") == []
    assert part_index.parts_with(index, asked(spark, [20]), "k") == ["a"]


@pytest.fixture(scope="module")
def states(spark):
    """A state of several line parts, one a load."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerloom-test-index/{uuid.uuid4().hex}"
    store = SnapshotLog(spark, root).store(4)
    parts = upkeep.first_state(store, "first", wh.initial_load(stage(spark, [line(i) for i in range(40)])))
    for n in (1, 2, 3):
        batch = stage(spark, [line(100 * n + i, order_date="2000-01-01") for i in range(40)])
        parts, _ = upkeep.incremental_load(store, f"load{n}", parts, batch)
    return store, parts


def test_a_load_reads_only_parts_that_can_hold_its_orders(spark, states):
    store, parts = states
    assert len(parts["order_details"]) == len(parts[upkeep.LINE_INDEX]) == 4
    orders = upkeep.read(spark, "orders", parts["orders"])
    for n in range(4):
        number = f"ORD-{100 * n + 7}"
        ids = orders.where(F.col("order_number") == number).select("order_id")
        found = upkeep.lines_of(spark, parts, ids)
        assert parts["order_details"][n] in found and len(found) <= 2
    assert upkeep.lines_of(spark, parts, orders.select("order_id")) == parts["order_details"]


def test_lines_without_an_index_are_always_read(spark, states):
    _, parts = states
    bare = {**parts, upkeep.LINE_INDEX: parts[upkeep.LINE_INDEX][:1]}
    none = upkeep.read(spark, "orders", parts["orders"]).limit(0).select("order_id")
    assert upkeep.lines_of(spark, bare, none) == parts["order_details"][1:]


def test_replayed_lines_are_found_in_every_part(spark, states):
    store, parts = states
    again = stage(spark, [line(100 * n + i, order_date="2000-01-01") for n in range(4) for i in (3, 9)])
    after, counts = upkeep.incremental_load(store, "replay", parts, again)
    assert counts["order_details"] == 0 and counts["orders"] == 0


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_history_is_cut_to_the_batch_before_it_is_grouped(spark):
    loaded, incoming = (stage(spark, [line(i) for i in range(3)]) for _ in range(2))
    for found, key in ((delta.delta_scd1_rows(loaded, incoming), "order_id"),
                       (delta.delta_scd2_rows(loaded, incoming), "customer_id"),
                       (delta.delta_duplicates(loaded, incoming), "order_id")):
        assert "LeftSemi" in plan(found) and key in plan(found)
