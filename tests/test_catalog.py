"""Persisted views, typed tables, intermediate tables, file fallback and audit times."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import audit, mart
from ledgerloom.plans.warehouse_run import warehouse
from ledgerloom.schemas import CORE, RAW_ORDERS
from ledgerloom.session import scratch_folder
from ledgerloom.sources import catalog, files

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def prefix(spark):
    own = f"t{uuid.uuid4().hex[:8]}_"
    yield own
    for table in spark.catalog.listTables():
        if table.name.startswith(own):
            spark.sql(f"drop view if exists {table.name}")


def test_views_equal_the_operators_and_are_replaceable(spark, prefix):
    run = warehouse(spark, SF)
    names = catalog.create_views(spark, run.parts("secondary"), prefix)
    assert {f"{prefix}fact_sales", f"{prefix}dim_customers", f"{prefix}core_orders"} <= set(names)
    assert all(not t.isTemporary for t in spark.catalog.listTables() if t.name.startswith(prefix))
    s = run.final()
    assert rows(spark.table(f"{prefix}fact_sales").select(mart.FACT_COLUMNS)) == rows(
        mart.fact_sales(s.order_details, s.orders, s.addresses))
    assert rows(spark.table(f"{prefix}dim_customers")) == rows(mart.dim_customers(s.customers, s.addresses))
    assert rows(spark.table(f"{prefix}dim_products")) == rows(mart.dim_products(s.products))
    # Defined again over an earlier state, the same names answer for that state.
    catalog.create_views(spark, run.parts("initial"), prefix)
    assert spark.table(f"{prefix}core_orders").count() == run.initial().orders.count() < s.orders.count()
    assert spark.sql(f"show create table {prefix}fact_sales").first()[0].lower().startswith("create view")


def test_a_view_of_no_folders_has_no_rows(spark, prefix):
    empty = spark.sql(catalog.core_view("orders", []))
    assert empty.count() == 0 and empty.columns == CORE["orders"].names


def test_typed_table(spark):
    table = catalog.TypedTable(spark, f"{scratch_folder(spark, 'test')}/t", CORE["customers"]).create()
    assert table.read().schema == CORE["customers"] and table.read().count() == 0
    table.insert(spark.createDataFrame([("7", "C7", "Ann", None)], "customer_id string, customer_number string, customer_name string, segment string"))
    assert [tuple(r) for r in table.read().collect()] == [(7, "C7", "Ann", None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        table.insert(spark.createDataFrame([("x", "C8", "Bob", None)], "customer_id string, customer_number string, customer_name string, segment string"))
    assert table.truncate().read().count() == 0


def test_temp_table_is_dropped_with_its_files(spark):
    with catalog.temp_table(spark.range(5), "some_rows") as t:
        assert spark.sql("select count(*) from some_rows").first()[0] == 5
        path = t.inputFiles()[0]
        assert files.exists(spark, path)
    assert not files.exists(spark, path) and not spark.catalog.tableExists("some_rows")
    with pytest.raises(RuntimeError), catalog.temp_table(spark.range(5), "some_rows"):
        raise RuntimeError
    assert not spark.catalog.tableExists("some_rows")


def test_fallback_only_where_the_file_is_missing(spark):
    run = warehouse(spark, SF)
    raw = run.raw_orders().select(*RAW_ORDERS.names)
    path = f"{scratch_folder(spark, 'test')}/raw"
    assert files.read_csv_or(spark, path, RAW_ORDERS, raw).count() == raw.count()
    files.write_csv(raw.limit(3), path)
    assert files.read_csv_or(spark, path, RAW_ORDERS, raw).count() == 3


def test_audit_times(spark):
    run = warehouse(spark, SF)
    times = {r.load_type: r for r in run.audit_times().collect()}
    assert set(times) == {"INITIAL", "SECONDARY"}
    assert times["INITIAL"].start_time <= times["INITIAL"].end_time <= times["SECONDARY"].end_time
    assert times["INITIAL"].start_time <= times["SECONDARY"].start_time
    old = run.audit_times().withColumn("start_time", F.current_timestamp() - F.expr("interval 2 hours"))
    assert old.where(audit.started_within("1 hour")).count() == 0
    assert old.where(audit.started_within("3 hours")).count() == 2
