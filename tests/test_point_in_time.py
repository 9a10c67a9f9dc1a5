"""The sorted sweep against a look at every version."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import mart
from ledgerloom.operators import point_in_time as pit
from ledgerloom.plans.warehouse_run import warehouse

SF = "/root/testdata/sf0.001"
DAY0 = dt.date(1999, 1, 1)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def tables(seed, hot=0.4):
    rng = random.Random(seed)
    who = lambda: 1 if rng.random() < hot else rng.choice([None, -3, 2, 3, 4, 5, 6, 2**40])
    headers = [(i, who(), day(rng.choice([None, *range(60)]) if rng.random() < .1 else rng.randrange(60))) for i in range(400)]
    versions = []
    for i in range(120):
        start = rng.choice([None, *range(-5, 60)]) if rng.random() < .1 else rng.randrange(-5, 60)
        end = None if rng.random() < .3 or start is None else start + rng.randrange(-1, 30)
        versions.append((i, who(), day(start), day(end), rng.choice([f"city {i}", None])))
    return headers, versions


def brute(headers, versions):
    out = []
    for i, who, at in headers:
        fit = [] if at is None or who is None else [
            (start, v, city) for v, owner, start, end, city in versions
            if owner == who and start is not None and start <= at and (end is None or at <= end)]
        out.append((i, who, at, max(fit, key=lambda x: x[:2])[2] if fit else None))
    return sorted(out, key=str)


def frames(spark, headers, versions):
    return (spark.createDataFrame(headers, "order_id long, customer_id long, order_date date"),
            spark.createDataFrame(versions, "address_id long, customer_id long, valid_from date, valid_to date, city string"))


@pytest.mark.parametrize("seed,ranges", [(1, 1), (2, 7), (3, 40), (4, None)])
def test_equals_a_look_at_every_version(spark, seed, ranges):
    headers, versions = tables(seed)
    h, v = frames(spark, headers, versions)
    got = pit.latest_version(h, v, ["city"], ranges=ranges)
    assert got.columns == ["order_id", "customer_id", "order_date", "city"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(headers, versions)


def test_empty_sides(spark):
    headers, versions = tables(5)
    h, v = frames(spark, headers, [])
    assert sorted(map(tuple, pit.latest_version(h, v, ["city"]).collect()), key=str) == brute(headers, [])
    h, v = frames(spark, [], versions)
    assert pit.latest_version(h, v, ["city"]).collect() == []


def test_an_owner_with_most_headers_is_split(spark):
    headers = [(i, 1, day(i % 90)) for i in range(900)] + [(1000 + i, 2 + i, day(i)) for i in range(90)]
    versions = [(1, 1, day(0), day(40), "old"), (2, 1, day(30), None, "new"), (3, 1, day(0), None, "base")]
    h, v = frames(spark, headers, versions)
    cuts = pit.borders(h, "customer_id", "order_date", 10)
    assert sum(c // pit.SPAN == 1 for c in cuts) >= 7          # most borders lie inside the hot owner
    assert sorted(map(tuple, pit.latest_version(h, v, ["city"], ranges=10).collect()), key=str) == brute(headers, versions)


def test_the_unique_fact_has_neither_explode_nor_window(spark):
    s = warehouse(spark, SF).final()
    fact = mart.fact_sales_unique(s.order_details, s.orders, s.addresses)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan
    assert fact.count() == s.order_details.count()
    # Where one version matches, both facts agree.
    wide = mart.fact_sales(s.order_details, s.orders, s.addresses)
    once = wide.groupBy("order_detail_id").agg(F.count("*").alias("n"), F.first("sales_city").alias("city")).where("n = 1")
    assert fact.join(once, "order_detail_id").where("not (sales_city <=> city)").isEmpty()
