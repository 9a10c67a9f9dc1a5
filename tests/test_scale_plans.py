"""What a step moves and sorts grows no faster than its rows."""

from __future__ import annotations

import datetime as dt

from ledgerloom import session
from ledgerloom.operators import keys, upkeep
from ledgerloom.operators import warehouse as wh
from ledgerloom.plans import fixtures
from ledgerloom.plans.queries_stage import union_delta_parts
from ledgerloom.plans.warehouse_run import WarehouseRun
from ledgerloom.schemas import CORE, DELTA_COLUMNS, RAW_ORDERS
from ledgerloom.sources import catalog
from tests.edge_frames import stage
from tests.test_upkeep import line

TABLES = {
    "region": "r_regionkey int, r_name string", "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"),
}


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_partitioned_writes_keep_their_folders_open(spark):
    before = spark.conf.get(session.WRITERS_CONF)
    try:
        spark.conf.set(session.WRITERS_CONF, "0")
        WarehouseRun(spark, "nowhere", digest="none")
        assert int(spark.conf.get(session.WRITERS_CONF)) == session.OPEN_WRITERS
        spark.conf.set(session.WRITERS_CONF, "3")
        session.keep_writers_open(spark)
        assert spark.conf.get(session.WRITERS_CONF) == "3"
    finally:
        spark.conf.set(session.WRITERS_CONF, before)


def test_shuffles_follow_the_input(spark):
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = (session.INITIAL_CONF, session._SIZED)
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n in names:
            spark.conf.unset(n)
        session.size_shuffles(spark, session.BYTES_A_PARTITION * few)
        assert spark.conf.get(session.INITIAL_CONF, None) is None and session.shuffle_partitions(spark) == few
        session.size_shuffles(spark, session.BYTES_A_PARTITION * 5 * few + 1)
        assert session.shuffle_partitions(spark) == 5 * few + 1
        assert f", {5 * few + 1})" in spark.range(9).repartitionByRange("id")._jdf.queryExecution().executedPlan().toString()
        session.size_shuffles(spark, 1)                                # an earlier, larger input may still be building
        assert session.shuffle_partitions(spark) == 5 * few + 1
        spark.conf.set(session.INITIAL_CONF, "3")                      # the session's own
        session.size_shuffles(spark, session.BYTES_A_PARTITION * 90 * few)
        assert spark.conf.get(session.INITIAL_CONF) == "3"
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_dimensions_are_joined_before_lines_meet_orders(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "read_table", lambda s, sf, t: s.createDataFrame([], TABLES[t]).coalesce(1))
    joins = [row for row in fixtures.fx_lines(spark, "")._jdf.queryExecution().analyzed().toString().splitlines() if "Join" in row]
    assert "l_orderkey" in joins[0] and not any("l_orderkey" in j for j in joins[1:])


def test_order_headers_are_cut_before_they_are_moved(spark):
    raw = stage(spark, [line(1, ship_date="2000-02-03"), line(1, ship_date="2000-02-01"), line(2)])
    customers = spark.createDataFrame([(7, "C1"), (8, "C2")], "customer_id long, customer_number string")
    rows = wh._order_rows(raw, customers, repair=False)
    assert "Aggregate" not in plan(rows) and plan(rows).index("Join") < plan(rows).index("Window")
    assert {(r["order_number"], str(r["ship_date"])) for r in rows.collect()} >= {("ORD-1", "2000-02-01")} and rows.count() == 2


def test_parts_of_a_year_are_written_without_a_shuffle(spark):
    class Store:
        def write(self, name, build, partition_by=None):
            self.frame, self.by = build(), partition_by
            return name

        def folders(self, path):
            return [path]
    store = Store()
    upkeep.write_years(store, "orders", lambda: upkeep.with_year(
        spark.createDataFrame([(dt.date(2000, 1, 1),)], "order_date date")))
    assert store.by == upkeep.YEAR and "Rebalance" not in plan(store.frame)


def flat_lines(spark, monkeypatch, rows):
    """``fx_lines`` on tables of the given rows."""
    monkeypatch.setattr(fixtures, "read_table", lambda s, sf, t: s.createDataFrame(rows[t], TABLES[t]))
    return fixtures.fx_lines(spark, "")


def small_tables():
    day = dt.datetime(2000, 1, 2)
    return {"region": [(0, "R")], "nation": [(0, "N", 0)], "customer": [(7, "C", 0, "S")], "part": [(5, "P", "Brand#1", "T", 3)],
            "orders": [(1, 7, day, "1-URGENT")],
            "lineitem": [(1, 5, 9, 1, 2.0, 100.0, 0.05, day), (1, 5, 9, 2, None, None, None, None), (99, 5, 9, 1, 1.0, 1e12, 0.0, day)]}


def test_lines_meet_orders_as_days_and_cents_with_one_copy_of_each_key(spark, monkeypatch):
    node = flat_lines(spark, monkeypatch, small_tables())._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().apply(0)
    moved = {}
    for side in (node.children().apply(0), node.children().apply(1)):
        for i in range(side.output().size()):
            moved[side.output().apply(i).name()] = side.output().apply(i).dataType().simpleString()
    assert {"l_orderkey", "o_orderkey", "l_partkey", "o_custkey"} <= set(moved)
    assert not {"p_partkey", "c_custkey"} & set(moved)
    assert not {"double", "timestamp_ntz", "timestamp"} & set(moved.values())


def test_values_of_lines_and_lines_without_an_order(spark, monkeypatch):
    """A price that fits no column matters on joined lines only."""
    rows = {r["k_line"]: r for r in flat_lines(spark, monkeypatch, small_tables()).collect()}
    assert set(rows) == {1, 2}
    one = rows[1]
    assert (one["row_key"], one["order_date"], one["ship_date"], one["customer_id"], one["product_id"]) == (
        "1-1-5-9", "2000-01-02", "2000-01-02", "CUST-7", "PROD-5")
    assert [str(one[c]) for c in ("sales", "quantity", "discount", "profit")] == ["95.00", "2", "0.05", "1.00"]
    assert [rows[2][c] for c in ("ship_date", "sales", "quantity", "discount", "profit")] == [None] * 5


def test_staged_lines_keep_no_column_that_others_give(spark, monkeypatch):
    whole = flat_lines(spark, monkeypatch, small_tables())
    kept = fixtures.tagged_lines(spark, "")
    assert not {"row_key", "customer_id", "product_id", "country", "city", "postal_code"} & set(kept.columns)
    assert whole.columns == [*RAW_ORDERS.names, *fixtures.HELPER_COLUMNS]
    again = fixtures.full_lines(kept.where("stage_part = 'delta'"))
    assert again.schema == whole.schema and sorted(map(str, again.collect())) == sorted(map(str, whole.collect()))
    one = again.where("k_line = 1").first()
    assert [one[c] for c in ("row_key", "customer_id", "country", "city", "postal_code", "product_id")] == [
        "1-1-5-9", "CUST-7", "USA", "CITY_7", 10007, "PROD-5"]


def test_union_of_delta_parts_reads_whole_lines(spark, tmp_path):
    rows = small_tables()
    rows["region"].append((1, "R1"))
    rows["orders"].append((50, 7, dt.datetime(1999, 1, 2), "1-URGENT"))
    rows["lineitem"].append((50, 5, 9, 1, 1.0, 10.0, 0.0, dt.datetime(1999, 1, 3)))
    for t, own in rows.items():
        spark.createDataFrame(own, TABLES[t]).write.parquet(f"{tmp_path}/{t}.parquet")
    found = union_delta_parts(spark, str(tmp_path))
    assert found.columns == list(DELTA_COLUMNS)
    assert sorted((r["row_key"], r["product_id"], r["region"]) for r in found.collect()) == [
        ("1-1-5-9", "PROD-5", "R"), ("1-2-5-9", "PROD-5", "R"), ("50-1-5-9", "PROD-5", "R"), ("S2-50-1-5-9", "PROD-5", "R1")]


def test_lines_meet_products_before_orders(spark):
    raw = stage(spark, [line(1), line(2)])
    orders = spark.createDataFrame([(1, "ORD-1"), (2, "ORD-2")], "order_id long, order_number string")
    products = spark.createDataFrame([(5, "P1"), (6, "P2")], "product_id long, product_number string")
    rows = wh._detail_rows(raw, orders, products)
    joins = [r for r in rows._jdf.queryExecution().analyzed().toString().splitlines() if "Join" in r]
    assert "order_number" in joins[0] and "product_number" in joins[1]
    assert {(r["order_id"], r["product_id"]) for r in rows.collect()} == {(1, 5), (2, 6)}


def test_packed_files_are_no_small_broadcast(spark, tmp_path):
    """300,000 rows in a few kilobytes of files are counted for what the driver would hold of them."""
    path = str(tmp_path / "packed")
    spark.range(300_000).selectExpr("id", "'one text' as text").coalesce(1).write.options(**keys.KEPT).parquet(path)
    assert sum(p.stat().st_size for p in (tmp_path / "packed").glob("*.parquet")) < 100_000
    before = {c: spark.conf.get(c) for c in (session.UNPACKED_CONF, "spark.sql.autoBroadcastJoinThreshold")}

    def join() -> str:
        left = spark.createDataFrame([(1,), (2,)], "id long")
        plan = left.join(spark.read.parquet(path), "id", "left")._jdf.queryExecution().sparkPlan().toString()
        return next(w for w in plan.split() if w.endswith("Join"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
        spark.conf.set(session.UNPACKED_CONF, "1.0")
        assert join() == "BroadcastHashJoin"
        session.size_broadcasts(spark)
        assert join() == "SortMergeJoin"
        spark.conf.set(session.UNPACKED_CONF, "7.0")
        session.size_broadcasts(spark)
        assert spark.conf.get(session.UNPACKED_CONF) == "7.0"       # the session's own
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_typed_tables_are_written_packed(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"P{i}", "Name", None, "S") for i in range(9)], CORE["products"])
    table = catalog.TypedTable(spark, str(tmp_path / "products"), CORE["products"]).create().insert(rows)
    filled = {p.name for p in (tmp_path / "products").glob("*.parquet")}
    assert filled and all(".zstd." in n for n in filled if ".snappy." not in n) and any(".zstd." in n for n in filled)
    assert sorted(map(str, table.read().collect())) == sorted(map(str, rows.collect()))
