"""Nothing is dropped on the way in; results outlive later calls; snapshots follow their input."""

from __future__ import annotations

import datetime as dt
import os
import shutil
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import columns as fc
from ledgerloom.operators import audit, mart
from ledgerloom.plans import registry, warehouse_run
from ledgerloom.session import ensure_checkpoint_dir, remove_scratch
from ledgerloom.sources import files
from ledgerloom.sources.tables import read_table

SF = "/root/testdata/sf0.001"
OTHER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def queries():
    registry.load_all()
    return registry.QUERIES


def test_every_line_is_staged_and_loaded(spark, queries):
    run = warehouse_run.warehouse(spark, SF)
    staged = spark.read.parquet(run.stage_lines())
    lines = read_table(spark, SF, "lineitem").count()
    assert staged.count() == lines
    late = staged.filter("stage_part = 'delta' and order_date < '2000-01-01'")
    assert late.count() > 0 and late.filter("k_cust % 13 <> 0 and k_part % 97 <> 0").count() == 0
    numbers = staged.select("order_id").distinct()
    loaded = run.final().orders.select(F.col("order_number").alias("order_id"))
    assert numbers.join(loaded, "order_id", "left_anti").count() == 0
    details = run.final().order_details.count()
    assert details >= lines * 0.99        # only repeated (order, product) pairs of re-sent lines are skipped
    assert queries["count_details"](spark, SF).first()[0] == details
    assert queries["fact_sales_unique"](spark, SF).count() == details


KEYED = ["initial_customers", "initial_products", "assign_surrogate_keys", "secondary_orders",
         "src_csv_latin1", "stage_append"]


@pytest.mark.parametrize("name", KEYED)
def test_an_earlier_result_survives_later_calls(spark, queries, name):
    first = queries[name](spark, SF)
    queries[name](spark, SF).count()
    queries[name](spark, OTHER)
    assert first.count() == queries[name](spark, SF).count()


def test_two_results_of_a_keyed_query_join(spark, queries):
    a, b = (queries["initial_customers"](spark, SF) for _ in range(2))
    assert a.join(b, "customer_id").count() == a.count()


def copied(tmp_path):
    out = tmp_path / "sf"
    out.mkdir()
    for t in warehouse_run.INPUT_TABLES:
        shutil.copy(f"{SF}/{t}.parquet", out / f"{t}.parquet")
        os.chmod(out / f"{t}.parquet", 0o644)
    return str(out)


def test_snapshots_follow_a_change_inside_a_folder(spark, tmp_path):
    sf = copied(tmp_path)
    orders = spark.read.parquet(f"{sf}/orders.parquet").withColumn("part", F.col("o_orderkey") % 2)
    rows = orders.toPandas()
    os.rename(f"{sf}/orders.parquet", f"{sf}/orders.file")
    spark.createDataFrame(rows, orders.schema).write.partitionBy("part").parquet(f"{sf}/orders.parquet")
    before = warehouse_run.warehouse(spark, sf)
    assert before is warehouse_run.warehouse(spark, sf)
    time.sleep(0.05)
    spark.createDataFrame(rows.head(3), orders.schema).drop("part").write.mode("append").parquet(f"{sf}/orders.parquet/part=0")
    after = warehouse_run.warehouse(spark, sf)
    assert after is not before and after.root != before.root


def test_concurrent_builders_publish_one_whole_copy(spark, tmp_path):
    sf = copied(tmp_path)
    runs = [warehouse_run.WarehouseRun(spark, sf) for _ in range(3)]
    with ThreadPoolExecutor(3) as pool:
        counts = list(pool.map(lambda r: r.raw_orders().count(), runs))
    assert len(set(counts)) == 1
    path = runs[0].stage_lines()
    assert sorted(n for n in os.listdir(path.removeprefix("file:")) if not n.startswith((".", "_"))) == [
        "stage_part=delta", "stage_part=initial"]


def test_a_far_date_adds_no_rows_for_others(spark):
    addresses = spark.createDataFrame(
        [(i, i, "USA", "c", "s", 1, "r", dt.date(1995, 1, 1), None, True) for i in range(1, 9)],
        "address_id long, customer_id long, country string, city string, state string, postal_code int, "
        "region string, valid_from date, valid_to date, is_current boolean")
    orders = spark.createDataFrame(
        [(i, f"O{i}", dt.date(1996, 1, i), dt.date(1996, 2, 1), "m", i) for i in range(1, 9)]
        + [(99, "O99", dt.date(9999, 12, 31), dt.date(9999, 12, 31), "m", 1), (98, "O98", dt.date(1990, 1, 1), None, "m", 2)],
        "order_id long, order_number string, order_date date, ship_date date, ship_mode string, customer_id long")
    out = mart.orders_with_geography(orders, addresses)
    assert out.count() == 10
    assert out.filter("sales_region is null").count() == 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_aggregate_before_they_join(spark, queries):
    for name in ("category_matrix", "decomposition_tree", "profit_margin", "unprofitable_subcategories", "sales_by_segment"):
        plan = queries[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.split("\n")
        join = next(i for i, x in enumerate(lines) if "Join" in x and "_id" in x)
        assert any("Aggregate" in x for x in lines[join:]), name


def test_kpi_cards_join_no_fact_rows(spark, queries):
    plan = queries["kpi_cards"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    cross = next(i for i, x in enumerate(plan) if "Join Cross" in x or "Join Inner" in x)
    assert "Aggregate" in plan[cross + 1] or "Project" in plan[cross + 1]
    assert any("Aggregate [order_date" in x for x in plan[cross:])


def test_year_filters_prune_the_mart(spark):
    fact = warehouse_run.warehouse(spark, SF).fact_by_year().filter("order_year = 1999")
    plan = executed(fact)
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert fact.count() > 0


def test_the_audit_log_is_kept(spark):
    log = {r.load_id: r for r in warehouse_run.warehouse(spark, SF).audit_log().collect()}
    assert {i: r.status for i, r in log.items()} == {1: "COMPLETED", 2: "COMPLETED"}
    started = audit.audit_started(spark, 3, "SECONDARY", "stage.delta_orders")
    assert [(r.load_id, r.status, r.rows_processed) for r in audit.audit_state(started).collect()] == [(3, "STARTED", 0)]


def test_bad_fields_fail_the_read(spark, tmp_path):
    path = str(tmp_path / "csv")
    files.write_source_csv(warehouse_run.warehouse(spark, SF).raw_orders().limit(3), path)
    name = next(n for n in os.listdir(path) if n.endswith(".csv"))
    with open(f"{path}/{name}", encoding="latin-1") as f:
        lines = f.read().split("\n")
    columns = lines[0].split(",")
    import csv
    row = next(csv.reader([lines[1]]))
    row[columns.index(files.TO_SOURCE_HEADER["quantity"])] = "abc"
    with open(f"{path}/bad.csv", "w", encoding="latin-1", newline="") as f:
        csv.writer(f).writerows([columns, row])
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD|FAILFAST|FAILED_READ_FILE"):
        files.read_source_csv(spark, path).collect()


def test_dates_with_a_time_of_day(spark):
    df = spark.createDataFrame([("2024-01-05 10:11:12",), ("2024-01-05T10:11:12",), ("1/5/2024",), ("2024-01-05",), ("x",), ("",)], "t string")
    got = [r.d for r in df.select(fc.parse_date_lenient("t").alias("d")).collect()]
    assert got == [dt.date(2024, 1, 5)] * 4 + [None, None]


def test_old_scratch_folders_go(spark, queries):
    queries["initial_products"](spark, SF).count()
    assert remove_scratch(spark, older_than_hours=1000) == 0
    assert ensure_checkpoint_dir(spark)
