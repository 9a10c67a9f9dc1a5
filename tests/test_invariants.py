"""Whole-warehouse invariants on the smallest tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.operators import warehouse as wh
from ledgerloom.plans.warehouse_run import warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    return warehouse(spark, SF)


def _one(df):
    (row,) = df.collect()
    return row


def test_sum_equals_sumx(spark):
    q = entry.queries()
    a = _one(q["total_sales"](spark, SF))["total_sales"]
    b = _one(q["total_sales_iterative"](spark, SF))["total_sales_iterative"]
    assert a == b


def test_shares_sum_to_one(spark):
    for name, col in (("pct_of_total", "pct_of_total"), ("sales_by_segment", "pct_of_total")):
        total = _one(entry.queries()[name](spark, SF).agg(F.sum(col)))[0]
        assert abs(total - 1.0) < 1e-9, name


def test_unique_fact_has_one_row_per_line(spark, run):
    s = run.final()
    assert entry.queries()["fact_sales_unique"](spark, SF).count() == s.order_details.count()


def test_one_current_address_after_cleanup(run):
    cur = run.cleaned().addresses.filter("is_current")
    assert cur.groupBy("customer_id").count().filter(F.col("count") > 1).count() == 0


def test_replaying_the_delta_adds_no_headers_or_lines(run):
    s = run.secondary()
    again = wh.secondary_load(s, run.delta_orders())
    assert again.counters["orders"].count() == 0
    assert again.counters["details"].count() == 0
    assert again.customers.count() == s.customers.count()
    assert again.products.count() == s.products.count()


def test_keys_are_dense_and_unique(run):
    s = run.final()
    for table, key in (("customers", "customer_id"), ("products", "product_id")):
        df = getattr(s, table)
        r = _one(df.agg(F.count(key), F.countDistinct(key), F.min(key), F.max(key)))
        assert r[0] == r[1] == r[3] and r[2] == 1, table


def test_dq_report_equals_the_individual_rules(spark):
    q = entry.queries()
    rules = ["dq_not_null", "dq_unique", "dq_foreign_keys", "dq_check_dates", "dq_ship_after_order",
             "dq_quantity", "dq_discount", "dq_lengths", "dq_one_current_address", "dq_fact_fanout"]
    separate = sorted(tuple(r) for n in rules for r in q[n](spark, SF).collect())
    report = sorted(tuple(r) for r in q["dq_report"](spark, SF).collect())
    assert report == separate
