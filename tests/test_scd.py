"""SCD1 / SCD2 edge cases on hand-built frames (literal expectations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.columns import effective_from
from ledgerloom.operators import warehouse as wh
from tests.edge_frames import D, address, core, stage


def _customers(spark, rows):
    return core(spark, "customers", rows)


def test_scd1_null_segment_never_triggers_alone(spark):
    customers = _customers(spark, [
        dict(customer_id=1, customer_number="C1", customer_name="Ann", segment=None),
        dict(customer_id=2, customer_number="C2", customer_name="Bob", segment="A"),
        dict(customer_id=3, customer_number="C3", customer_name="Cy", segment=None),
    ])
    delta = stage(spark, [
        dict(row_key="1", customer_id="C1", customer_name="Ann", segment="X"),
        dict(row_key="2", customer_id="C2", customer_name="Bob", segment=None),
        dict(row_key="3", customer_id="C3", customer_name="Cyrus", segment="Z"),
    ])
    changes = {r["customer_id"]: (r["new_name"], r["new_segment"])
               for r in wh.scd1_changes(customers, delta).collect()}
    assert changes == {3: ("Cyrus", "Z")}
    out, _ = wh.scd1_customers(customers, delta)
    got = {r["customer_number"]: (r["customer_name"], r["segment"]) for r in out.collect()}
    assert got == {"C1": ("Ann", None), "C2": ("Bob", "A"), "C3": ("Cyrus", "Z")}


def test_scd1_two_renames_latest_wins(spark):
    customers = _customers(spark, [dict(customer_id=1, customer_number="C1",
                                        customer_name="Ann", segment="A")])
    delta = stage(spark, [
        dict(row_key="a", customer_id="C1", customer_name="Ann B", order_date="2000-01-09"),
        dict(row_key="b", customer_id="C1", customer_name="Ann C", order_date="2000-01-05"),
        dict(row_key="c", customer_id="C1", customer_name="Ann D", order_date="2000-01-09"),
    ])
    (row,) = wh.scd1_changes(customers, delta).collect()
    # latest order date, then the greatest row key
    assert row["new_name"] == "Ann D"


def test_scd1_inserts_new_customers_first_wins(spark):
    customers = _customers(spark, [dict(customer_id=5, customer_number="C1",
                                        customer_name="Ann", segment="A")])
    delta = stage(spark, [
        dict(customer_id="C9", customer_name="Zed", segment="B"),
        dict(customer_id="C9", customer_name="Ned", segment="B"),
        dict(customer_id="C7", customer_name="Sue", segment=None),
    ])
    out, _ = wh.scd1_customers(customers, delta)
    got = sorted((r["customer_id"], r["customer_number"], r["customer_name"]) for r in out.collect())
    assert got == [(5, "C1", "Ann"), (6, "C7", "Sue"), (7, "C9", "Ned")]


def _close_case(spark, new_from: str):
    customers = _customers(spark, [dict(customer_id=1, customer_number="C1",
                                        customer_name="Ann", segment="A")])
    addresses = core(spark, "addresses", [address(1, 1, D(2000, 1, 10))])
    delta = stage(spark, [dict(customer_id="C1", region="EUROPE", valid_from=new_from,
                               order_date=new_from, is_new_version=True)])
    closed, _ = wh.scd2_close_versions(addresses, customers, delta)
    (row,) = closed.collect()
    return row


def test_scd2_close_day_before_rule(spark):
    row = _close_case(spark, "2000-02-01")
    assert (row["is_current"], row["valid_to"]) == (False, D(2000, 1, 31))


def test_scd2_close_same_day_edge_cases(spark):
    # new start equal to, one day after, and before the old start: valid_to = old start
    for new_from in ("2000-01-10", "2000-01-11", "2000-01-05"):
        row = _close_case(spark, new_from)
        assert (row["is_current"], row["valid_to"]) == (False, D(2000, 1, 10)), new_from


def test_scd2_country_only_change_with_and_without_flag(spark):
    customers = _customers(spark, [dict(customer_id=1, customer_number="C1",
                                        customer_name="Ann", segment="A")])
    addresses = core(spark, "addresses", [address(1, 1, D(1999, 1, 1))])
    flagged = stage(spark, [dict(customer_id="C1", country="CAN", valid_from="2000-03-01",
                                 is_new_version=True)])
    out, _, new = wh.scd2_addresses(addresses, customers, flagged)
    rows = sorted((r["address_id"], r["country"], r["is_current"], r["valid_to"])
                  for r in out.collect())
    assert rows == [(1, "USA", False, D(2000, 2, 29)), (2, "CAN", True, None)]

    unflagged = stage(spark, [dict(customer_id="C1", country="CAN", valid_from="2000-03-01",
                                   is_new_version=False)])
    out, _, new = wh.scd2_addresses(addresses, customers, unflagged)
    assert new.count() == 0
    assert [(r["country"], r["is_current"]) for r in out.collect()] == [("USA", True)]


def test_scd2_non_version_row_adds_second_current_address(spark):
    customers = _customers(spark, [dict(customer_id=1, customer_number="C1",
                                        customer_name="Ann", segment="A")])
    addresses = core(spark, "addresses", [address(1, 1, D(1999, 1, 1))])
    delta = stage(spark, [dict(customer_id="C1", city="CITY_9", valid_from="2000-03-01")])
    out, closing, _ = wh.scd2_addresses(addresses, customers, delta)
    assert closing.count() == 0
    current = sorted(r["city"] for r in out.filter("is_current").collect())
    assert current == ["CITY_1", "CITY_9"]


def test_scd2_null_attributes_compare_null_safe(spark):
    customers = _customers(spark, [dict(customer_id=1, customer_number="C1",
                                        customer_name="Ann", segment="A")])
    addresses = core(spark, "addresses", [address(1, 1, D(1999, 1, 1), postal_code=None)])
    same = stage(spark, [dict(customer_id="C1", postal_code=None, is_new_version=True)])
    out, closing, new = wh.scd2_addresses(addresses, customers, same)
    assert closing.count() == 0 and new.count() == 0


def test_effective_from_blank_and_null_fall_back_to_order_date(spark):
    df = stage(spark, [dict(row_key="1", valid_from="", order_date="2000-03-01"),
                       dict(row_key="2", valid_from=None, order_date="2000-03-02"),
                       dict(row_key="3", valid_from="2000-04-01", order_date="2000-03-03")])
    got = {r["row_key"]: r["e"] for r in
           df.select("row_key", effective_from("valid_from", "order_date").alias("e")).collect()}
    assert got == {"1": D(2000, 3, 1), "2": D(2000, 3, 2), "3": D(2000, 4, 1)}


def test_cleanup_keeps_newest_current_address(spark):
    addresses = core(spark, "addresses", [
        address(1, 1, D(1999, 1, 1)), address(2, 1, D(1999, 1, 1), city="CITY_2"),
        address(3, 2, D(1999, 5, 1)), address(4, 2, D(1999, 1, 1), city="CITY_4"),
    ])
    out = {r["address_id"]: (r["is_current"], r["valid_to"])
           for r in wh.cleanup_addresses(addresses).collect()}
    # ties on valid_from: the highest address id survives; others end a day after they began
    assert out == {1: (False, D(1999, 1, 2)), 2: (True, None),
                   3: (True, None), 4: (False, D(1999, 1, 2))}
    assert (wh.cleanup_addresses(addresses).filter("is_current")
            .groupBy("customer_id").count().filter(F.col("count") > 1).count()) == 0


def test_scd2_close_uses_earliest_differing_version(spark):
    customers = _customers(spark, [dict(customer_id=1, customer_number="C1", customer_name="Ann",
                                        segment="A"),
                                   dict(customer_id=2, customer_number="C2", customer_name="Bo",
                                        segment="A")])
    addresses = core(spark, "addresses", [
        address(1, 1, D(1999, 1, 1), city="A"),      # equal to the earliest version
        address(2, 1, D(1999, 1, 1), city="Z"),      # differs from every version
        address(3, 2, D(1999, 1, 1), city="Q"),      # only version is identical
    ])
    delta = stage(spark, [
        dict(row_key="1", customer_id="C1", city="X", valid_from="2000-03-01", is_new_version=True),
        dict(row_key="2", customer_id="C1", city="A", valid_from="2000-01-01", is_new_version=True),
        dict(row_key="3", customer_id="C1", city="Y", valid_from="2000-02-01", is_new_version=True),
        dict(row_key="4", customer_id="C1", city="Y", valid_from="2000-05-01", is_new_version=True),
        dict(row_key="5", customer_id="C2", city="Q", valid_from="2000-01-01", is_new_version=True),
    ])
    got = {r["address_id"]: r["new_from"]
           for r in wh.scd2_close_candidates(addresses, customers, delta).collect()}
    assert got == {1: D(2000, 2, 1), 2: D(2000, 1, 1)}
