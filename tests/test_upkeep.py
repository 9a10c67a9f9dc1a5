"""A load rewrites only the folders it must; its counts are those of its writes."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import audit, upkeep
from ledgerloom.operators import warehouse as wh
from ledgerloom.plans import warehouse_run
from ledgerloom.plans.warehouse_run import warehouse
from ledgerloom.session import ensure_checkpoint_dir
from ledgerloom.streaming.incremental import SnapshotLog
from tests.edge_frames import stage

SF = "/root/testdata/sf0.001"
BUCKETS = 64


@pytest.fixture(scope="module")
def store(spark):
    return SnapshotLog(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerloom-test-upkeep/{uuid.uuid4().hex}").store(BUCKETS)


def line(i, **kw):
    return dict(dict(row_key=str(i), order_id=f"ORD-{i}", customer_id=f"C{i}", customer_name=f"Name {i}", segment="S",
                     region="R", state="T", city=f"City {i}", product_id=f"P{i % 9}", order_date="1999-01-01",
                     ship_date="1999-01-02"), **kw)


@pytest.fixture(scope="module")
def loaded(spark, store):
    state = wh.initial_load(stage(spark, [line(i) for i in range(300)]))
    return upkeep.first_state(store, "first", state)


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_batch_of_ten_customers_rewrites_at_most_ten_buckets(spark, store, loaded):
    assert len(loaded["customers"]) > 50
    renamed = [line(1000 + i, customer_id=f"C{i}", customer_name=f"New {i}", city=f"City {i}") for i in range(4)]
    moved = [line(2000 + i, customer_id=f"C{i}", customer_name=f"Name {i}", city="Elsewhere", order_date="2000-02-01",
                  valid_from="2000-02-01", is_new_version=True) for i in range(4, 8)]
    unseen = [line(3000 + i, customer_id=f"X{i}", order_date="2000-02-01") for i in range(2)]
    delta = stage(spark, renamed + moved + unseen)
    parts, counts = upkeep.incremental_load(store, "ten", loaded, delta)
    for table, most in (("customers", 6), ("addresses", 6)):
        changed = set(parts[table]) - set(loaded[table])
        assert 0 < len(changed) <= most
        assert len(parts[table]) >= len(loaded[table])
        kept = set(parts[table]) & set(loaded[table])
        assert len(kept) >= len(loaded[table]) - most
    assert (counts["scd1"], counts["new_customers"], counts["closed"], counts["new_versions"]) == (4, 2, 4, 6)
    assert counts["orders"] == 10
    # The same rows as the statements give on whole tables.
    before = wh.CoreState(**{t: upkeep.read(spark, t, loaded[t]) for t in warehouse_run.TABLES})
    whole = wh.secondary_load(before, delta)
    for t, df in whole.tables().items():
        assert rows(upkeep.read(spark, t, parts[t]).select(df.columns)) == rows(df)


def test_a_batch_without_changes_rewrites_nothing(spark, store, loaded):
    delta = stage(spark, [line(1), line(2)])
    parts, counts = upkeep.incremental_load(store, "same", loaded, delta)
    assert parts["customers"] == loaded["customers"] and parts["addresses"] == loaded["addresses"]
    assert not any(counts.values())


def test_an_empty_batch(spark, store, loaded):
    parts, counts = upkeep.incremental_load(store, "none", loaded, stage(spark, []))
    assert parts["customers"] == loaded["customers"] and not any(counts.values())


def test_the_search_for_changes_reads_only_the_batchs_buckets(spark, store, loaded):
    delta = stage(spark, [line(1, customer_name="Other")])
    asked = upkeep.in_buckets([delta.select(F.col("customer_id").alias("customer_number"))], "customer_number", BUCKETS)
    files = upkeep.read(spark, "customers", upkeep.of_buckets(loaded["customers"], asked)).inputFiles()
    assert len(asked) == 1 and len({f.rsplit("/", 1)[0] for f in files}) == 1


def test_clean_up_rewrites_only_customers_with_several_current_addresses(spark, store):
    lines = [line(i) for i in range(200)] + [line(900 + i, customer_id=f"C{i}", city="Second") for i in range(3)]
    parts = upkeep.first_state(store, "double", wh.initial_load(stage(spark, lines)))
    after = upkeep.clean_up(store, "tidy", parts["addresses"])
    assert 0 < len(set(after) - set(parts["addresses"])) <= 3
    current = upkeep.read(spark, "addresses", after).where("is_current").groupBy("customer_id").count()
    assert current.where("count > 1").isEmpty()
    assert upkeep.clean_up(store, "again", after) == after


def test_the_audit_row_is_the_kept_one(spark):
    run = warehouse(spark, SF)
    log = run.audit_log()
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "delta_orders" not in plan        # no statement of the load runs again
    c, delta = run.cleaned(), run.delta_orders()
    by_recount = {
        "orders": wh.secondary_orders(c.orders, run.secondary().customers, delta).count(),
        "scd1": wh.scd1_changes(c.customers, delta).count(),
        "closed": wh.scd2_closings(c.addresses, run.secondary().customers, delta).count()}
    row = log.where("load_type = 'SECONDARY'").first()
    assert (row.load_id, row.rows_inserted, row.rows_updated, row.rows_skipped) == (
        2, by_recount["orders"], by_recount["scd1"] + by_recount["closed"], delta.count() - by_recount["orders"])


def test_counts_survive_a_restart(spark):
    run = warehouse(spark, SF)
    run.secondary()
    other = warehouse_run.WarehouseRun(spark, SF)
    path = f"{run.root}/initial/order_details"
    assert other.root == run.root and other.rows(path) == run.rows(path)


def test_a_second_initial_load_is_refused(spark):
    raw = stage(spark, [line(1)])
    started = audit.audit_started(spark, 1, "INITIAL", "stage.raw_orders")
    wh.initial_load(raw, started)
    with pytest.raises(ValueError, match="already"):
        wh.initial_load(raw, started.union(audit.audit_counted(spark, 1, "INITIAL", "stage.raw_orders", 1)))


def test_load_ids_follow_the_log(spark):
    assert audit.next_load_id(None) == 1
    assert audit.next_load_id(audit.audit_started(spark, 7, "INITIAL", "x").limit(0)) == 1
    assert audit.next_load_id(audit.audit_started(spark, 7, "INITIAL", "x")) == 8


def test_the_correction_rewrites_only_its_years(spark):
    run = warehouse(spark, SF)
    before, after = run.parts("secondary"), run.parts("correction")
    years = set(range(warehouse_run.CORRECTION.start.year, warehouse_run.CORRECTION.end.year + 1))
    for t in upkeep.BY_YEAR:
        assert len({upkeep.part_year(p) for p in before[t]}) > 3
        changed = [p for p in before[t] if p not in after[t]]
        assert changed and {upkeep.part_year(p) for p in changed} <= years
        assert len(after[t]) == len(before[t])
    whole = wh.correct_period(*(run.secondary().tables()[t] for t in upkeep.BY_YEAR), warehouse_run.CORRECTION)
    assert rows(run.corrected().orders) == rows(whole[0].select(run.corrected().orders.columns))
    assert run.corrected().order_details.count() == whole[1].count()


def test_orders_without_a_date_are_kept(spark, store):
    lines = [line(1), line(2, order_date="not a date")]
    parts = upkeep.first_state(store, "dateless", wh.initial_load(stage(spark, lines)))
    assert {upkeep.part_year(p) for p in parts["orders"]} == {1999, None}
    assert upkeep.read(spark, "orders", parts["orders"]).count() == upkeep.read(spark, "order_details", parts["order_details"]).count() == 2
