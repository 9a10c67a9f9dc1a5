"""Point-in-time join, time intelligence and DIVIDE semantics on small frames."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import parse_date_lenient, safe_divide
from ledgerloom.operators import mart
from ledgerloom.operators import measures as m
from tests.edge_frames import D, address, core


def _pit_frames(spark):
    addresses = core(spark, "addresses", [
        address(1, 1, D(2000, 1, 1), D(2000, 1, 31), False, region="A"),
        address(2, 1, D(2000, 2, 1), None, True, region="B"),
        address(3, 1, D(2000, 1, 15), D(2000, 1, 20), False, region="C"),
    ])
    orders = core(spark, "orders", [
        dict(order_id=i, customer_id=c, order_number=f"O{i}", order_date=d, ship_date=d,
             ship_mode="x", batch_id=1)
        for i, c, d in [(1, 1, D(2000, 1, 1)), (2, 1, D(2000, 1, 31)), (3, 1, D(2000, 2, 1)),
                        (4, 1, D(1999, 12, 31)), (5, 2, D(2000, 1, 5)), (6, 1, D(2000, 1, 16))]])
    details = core(spark, "order_details", [
        dict(order_detail_id=i, order_id=i, product_id=1, sales=Decimal("1.00"), quantity=1,
             discount=Decimal("0.00"), profit=Decimal("0.10")) for i in range(1, 7)])
    return details, orders, addresses


def test_point_in_time_inclusive_ends_and_fanout(spark):
    details, orders, addresses = _pit_frames(spark)
    fact = mart.fact_sales(details, orders, addresses)
    got = sorted((r["order_id"], r["sales_region"]) for r in fact.collect())
    assert got == [(1, "A"), (2, "A"), (3, "B"), (4, None), (5, None), (6, "A"), (6, "C")]
    uniq = {r["order_id"]: r["sales_region"]
            for r in mart.fact_sales_unique(details, orders, addresses).collect()}
    assert uniq == {1: "A", 2: "A", 3: "B", 4: None, 5: None, 6: "C"}
    assert mart.fact_sales_unique(details, orders, addresses).count() == details.count()


def _fact(spark, rows):
    schema = T.StructType([T.StructField("order_date", T.DateType()),
                           T.StructField("sales", T.DecimalType(10, 2)),
                           T.StructField("profit", T.DecimalType(10, 2))])
    return spark.createDataFrame([(d, Decimal(s), Decimal(p)) for d, s, p in rows], schema)


def test_sply_29_february_and_missing_previous_year(spark):
    fact = _fact(spark, [(D(1999, 2, 28), "10.00", "1.00"), (D(2000, 2, 29), "5.00", "1.00")])
    cal = mart.calendar(fact)
    assert cal.count() == 365 + 366
    sply = {r["date"]: r["sales_sply"] for r in m.sales_sply_daily(fact, cal).collect()}
    assert sply[D(2000, 2, 29)] == Decimal("10.00")
    assert sply[D(2000, 2, 28)] == Decimal("10.00")
    yoy = {r["year"]: r["sales_yoy"] for r in m.yearly_yoy(fact, cal).collect()}
    assert yoy[1999] == 0.0                      # no last year → DIVIDE alternate result
    assert abs(yoy[2000] - (5 - 10) / 10) < 1e-12


def test_ytd_resets_each_year_and_keeps_blank_days(spark):
    fact = _fact(spark, [(D(1999, 12, 31), "7.00", "0"), (D(2000, 1, 2), "3.00", "0"),
                         (D(2000, 1, 5), "4.00", "0")])
    ytd = {r["date"]: (r["total_sales"], r["sales_ytd"])
           for r in m.sales_ytd(fact, mart.calendar(fact)).collect()}
    assert ytd[D(2000, 1, 1)] == (None, None)
    assert ytd[D(2000, 1, 3)] == (None, Decimal("3.00"))
    assert ytd[D(2000, 1, 5)] == (Decimal("4.00"), Decimal("7.00"))
    assert ytd[D(1999, 12, 31)] == (Decimal("7.00"), Decimal("7.00"))


def test_divide_alternate_result(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (None, 2.0), (1.0, 4.0)],
                               "p double, s double")
    got = [r[0] for r in df.select(safe_divide("p", "s")).collect()]
    assert got == [0.0, 0.0, None, 0.25]


def test_pct_of_total_uses_unfiltered_total(spark):
    fact = _fact(spark, [(D(2000, 1, 1), "30.00", "0"), (D(2000, 1, 2), "10.00", "0")])
    fact = fact.withColumn("g", F.when(F.col("sales") > 20, "big").otherwise("small"))
    filtered = fact.filter("g = 'small'")
    (row,) = m.pct_of_total(fact, ["g"], filtered).collect()
    assert row["g"] == "small" and abs(row["pct_of_total"] - 0.25) < 1e-12


def test_lenient_date_parsing(spark):
    df = spark.createDataFrame([("2000-01-05",), ("1/5/2000",), ("garbage",), ("",), (None,)],
                               "t string")
    got = [r[0] for r in df.select(parse_date_lenient("t")).collect()]
    assert got == [D(2000, 1, 5), D(2000, 1, 5), None, None, None]


def test_named_customer_must_be_unique(spark):
    import pytest
    from ledgerloom.operators.reports import orders_of_named_customer
    details, orders, addresses = _pit_frames(spark)
    fact = mart.fact_sales(details, orders, addresses)
    customers = core(spark, "customers", [
        dict(customer_id=1, customer_number="C1", customer_name="Ann", segment="A"),
        dict(customer_id=2, customer_number="C2", customer_name="Ann", segment="B")])
    with pytest.raises(Exception, match="more than one customer"):
        orders_of_named_customer(fact, customers, "Ann").collect()
    unique = customers.filter("customer_id = 1")
    assert orders_of_named_customer(fact, unique, "Ann").count() == 6
