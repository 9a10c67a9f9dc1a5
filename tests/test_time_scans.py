"""Time intelligence sums the fact once and joins only what a measure needs."""

from __future__ import annotations

import datetime as dt

import pytest

from ledgerloom.operators import time_intelligence as ti
from ledgerloom.plans import queries_time


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def fact(spark):
    return spark.createDataFrame([("a", dt.date(1999, 2, 28), 5.0), (None, dt.date(2000, 2, 29), 7.0)],
                                 "sales_state string, order_date date, sales double")


def test_last_year_is_summed_in_the_pass_of_this_year(spark, fact):
    calendar = spark.sql("select explode(sequence(date'1999-01-01', date'2000-12-31')) as date")
    out = ti.same_period_last_year(fact, ["sales_state"], calendar, "day")
    assert "Union" not in plan(out)
    rows = {(r["sales_state"], str(r["period"])): (r["total_sales"], r["sales_sply"]) for r in out.collect()}
    assert rows == {("a", "1999-02-28"): (5.0, None), ("a", "2000-02-28"): (None, 5.0),
                    ("a", "2000-02-29"): (None, 5.0), (None, "2000-02-29"): (7.0, None)}


def test_sums_by_state_join_no_product(spark, fact, monkeypatch):
    class Run:
        def fact_sales(self):
            return fact

        def dim_products(self):
            raise AssertionError("the product dimension is not needed")
    monkeypatch.setattr(queries_time, "W", lambda s, sf: Run())
    last = queries_time.sales_ytd_by_state(spark, "").where("date = '2000-12-31'").collect()
    assert [(r["sales_state"], r["sales_ytd"]) for r in last] == [(None, 7.0)]
