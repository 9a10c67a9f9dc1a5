"""Core-layer maintenance as pure ``(old state, batch) -> new state`` functions.

Parquet has no UPDATE/DELETE/MERGE, so every step returns new frames that a
caller writes as a fresh snapshot. Statement order matters and is kept: each
step reads the frames produced by the previous one (customers → SCD2 close →
SCD2 insert → products → orders → details).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import (
    asc_last, effective_from, md5_bucket, not_distinct_all, parse_date, repair_quantity,
    repair_ship_date)
from ledgerloom.operators.audit import refuse_second_initial
from ledgerloom.operators.dedupe import first_wins, keep_newest_flags, latest_per_key
from ledgerloom.operators.keys import assign_dense_keys
from ledgerloom.schemas import (
    ADDRESS_ATTRS, ADDRESSES, CUSTOMERS, ORDER_DETAILS, ORDERS, PRODUCTS)

# Attributes whose change closes a version (5) and those the insert test
# compares (4, no country) — the asymmetry is the reference's.
CLOSE_ATTRS = ["region", "state", "city", "postal_code", "country"]
INSERT_MATCH_ATTRS = ["region", "state", "city", "postal_code"]
DETAIL_ORDER = ["order_id", "product_id", "sales", "quantity", "discount", "profit"]
ADDRESS_ORDER = ["customer_id", "country", "city", "state", "postal_code", "region", "valid_from"]


@dataclass
class CoreState:
    """The five core tables of one warehouse state, plus the counters of the
    load step that produced it."""
    customers: DataFrame
    addresses: DataFrame
    products: DataFrame
    orders: DataFrame
    order_details: DataFrame
    counters: dict[str, DataFrame] = field(default_factory=dict)
    # New rows of append-only tables (products, orders, order_details): a
    # snapshot writer stores only these and keeps the earlier parts as they are.

    def tables(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "addresses": self.addresses,
                "products": self.products, "orders": self.orders,
                "order_details": self.order_details}


def _max_of(df: DataFrame, c: str) -> DataFrame:
    return df.agg(F.max(c).alias("_m"))


def _stage_customers(stage: DataFrame) -> DataFrame:
    return stage.select(F.col("customer_id").alias("customer_number"), "customer_name", "segment")


def _stage_products(stage: DataFrame) -> DataFrame:
    return stage.select(F.col("product_id").alias("product_number"), "product_name", "category",
                        "sub_category")


def _customer_ids(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_number")


# ---------------------------------------------------------------- initial load

def initial_customers(raw: DataFrame) -> DataFrame:
    """M1: one row per customer number (first wins over name, segment), dense ids in number order."""
    picked = first_wins(_stage_customers(raw), ["customer_number"])
    return assign_dense_keys(picked, "customer_id", asc_last("customer_number")).select(*CUSTOMERS)


def initial_addresses(raw: DataFrame, customers: DataFrame) -> DataFrame:
    """Every distinct address of a customer, all current, all starting on the
    customer's first order date."""
    # Distinct addresses and each customer's first order date, both as
    # map-side-combined aggregates; a customer with very many addresses is a
    # skewed join key that AQE can split (a window over it could not be).
    per_address = (raw.groupBy(F.col("customer_id").alias("customer_number"), *ADDRESS_ATTRS)
                   .agg(F.min(parse_date("order_date")).alias("_first")))
    first_order = per_address.groupBy("customer_number").agg(F.min("_first").alias("valid_from"))
    rows = (per_address.join(first_order, "customer_number")
            .join(_customer_ids(customers), "customer_number")
            .select("customer_id", *ADDRESS_ATTRS, "valid_from"))
    keyed = assign_dense_keys(rows, "address_id", asc_last(*ADDRESS_ORDER))
    return (keyed.withColumn("valid_to", F.lit(None).cast("date"))
            .withColumn("is_current", F.lit(True)).select(*ADDRESSES))


def initial_products(raw: DataFrame) -> DataFrame:
    """M3: one row per product number (first wins), dense ids in number order."""
    picked = first_wins(_stage_products(raw), ["product_number"])
    return assign_dense_keys(picked, "product_id", asc_last("product_number")).select(*PRODUCTS)


def _order_rows(stage: DataFrame, customers: DataFrame, repair: bool) -> DataFrame:
    """One header a customer and order number: of several the first in the order of its columns."""
    order_date = parse_date("order_date")
    ship_date = parse_date("ship_date")
    if repair:
        ship_date = repair_ship_date(ship_date, order_date)
    rows = stage.select(F.col("customer_id").alias("customer_number"),
                        F.col("order_id").alias("order_number"),
                        order_date.alias("order_date"), ship_date.alias("ship_date"),
                        "ship_mode")
    # A customer's rows of one order are cut to the one that wins before they are moved and joined.
    return (first_wins(rows, ["order_number", "customer_number"]).join(_customer_ids(customers), "customer_number")
            .select("customer_id", "order_number", "order_date", "ship_date", "ship_mode"))


def initial_orders(raw: DataFrame, customers: DataFrame, batch_id: int = 1,
                   repair: bool = False) -> DataFrame:
    """Order headers of the first batch; one survivor per order number.

    ``repair`` applies the ship-date repair the incremental load uses (the
    initial script casts raw dates; conflicting rows are reported by the
    ``dq_ship_after_order`` rule instead)."""
    picked = first_wins(_order_rows(raw, customers, repair), ["order_number"])
    keyed = assign_dense_keys(picked, "order_id", asc_last("order_number"))
    return keyed.withColumn("batch_id", F.lit(batch_id)).select(*ORDERS)


def _detail_rows(stage: DataFrame, orders: DataFrame, products: DataFrame,
                 quantity=None, carry: Sequence[str] = ()) -> DataFrame:
    qty = quantity if quantity is not None else F.col("quantity")
    lines = stage.select(F.col("order_id").alias("order_number"),
                         F.col("product_id").alias("product_number"),
                         "sales", qty.alias("quantity"), "discount", "profit")
    # Products first: where they fit a broadcast, lines move to their orders with an id and no number in text.
    return (lines.join(products.select("product_id", "product_number"), "product_number")
            .join(orders.select("order_id", "order_number", *carry), "order_number")
            .select(*DETAIL_ORDER, *carry))


def initial_order_details(raw: DataFrame, orders: DataFrame, products: DataFrame,
                          carry: Sequence[str] = ()) -> DataFrame:
    """M5: every stage line joined to its order and product ids (no dedup, as in the first load).
    ``carry`` names columns of ``orders`` that the lines take along."""
    rows = _detail_rows(raw, orders, products, carry=carry)
    return assign_dense_keys(rows, "order_detail_id", asc_last(*DETAIL_ORDER)).select(*ORDER_DETAILS, *carry)


def initial_load(raw: DataFrame, log: DataFrame | None = None) -> CoreState:
    """M1–M5 in statement order on the first stage batch. Lines are not checked
    against loaded ones, so with a ``log`` of earlier loads a second initial load is refused."""
    refuse_second_initial(log)
    customers = initial_customers(raw)
    products = initial_products(raw)
    orders = initial_orders(raw, customers)
    return CoreState(customers=customers,
                     addresses=initial_addresses(raw, customers),
                     products=products, orders=orders,
                     order_details=initial_order_details(raw, orders, products))


# ------------------------------------------------------------------ clean-up

def addresses_to_close(addresses: DataFrame) -> DataFrame:
    """Current addresses that are not their customer's newest current one."""
    current = addresses.filter(F.col("is_current"))
    return keep_newest_flags(current, "customer_id", "address_id", ["valid_from"])


def cleanup_addresses(addresses: DataFrame) -> DataFrame:
    """Keep one current address per customer; older ones end a day after they began."""
    closing = addresses_to_close(addresses).withColumn("_close", F.lit(True))
    hit = F.coalesce(F.col("_close"), F.lit(False))
    return (addresses.join(closing, "address_id", "left")
            .withColumn("valid_to", F.when(hit, F.date_add("valid_from", 1))
                        .otherwise(F.col("valid_to")))
            .withColumn("is_current", F.when(hit, F.lit(False)).otherwise(F.col("is_current")))
            .select(*ADDRESSES))


# ------------------------------------------------------------ incremental load

def next_batch_id(orders: DataFrame) -> DataFrame:
    """COALESCE(MAX(batch_id), 1) + 1 as a one-row frame."""
    return orders.agg((F.coalesce(F.max("batch_id"), F.lit(1)) + 1).alias("batch_id"))


def scd1_changes(customers: DataFrame, delta: DataFrame) -> DataFrame:
    """Customers whose name or segment differs in the batch, with the value to
    apply. ``!=`` is 3-valued as in the load script: a NULL on either side never
    triggers on its own. Among several differing rows the latest order date,
    then the greatest row key wins."""
    cand = delta.select(F.col("customer_id").alias("customer_number"),
                        F.col("customer_name").alias("new_name"),
                        F.col("segment").alias("new_segment"),
                        parse_date("order_date").alias("_od"), "row_key")
    # Collapse each customer's rows to one per distinct (name, segment) first.
    cand = latest_per_key(cand, ["customer_number", "new_name", "new_segment"], ["_od", "row_key"])
    diff = (customers.join(cand, "customer_number")
            .filter((F.col("customer_name") != F.col("new_name"))
                    | (F.col("segment") != F.col("new_segment"))))
    picked = latest_per_key(diff, ["customer_id"], ["_od", "row_key", "new_name", "new_segment"])
    return picked.select("customer_id", "customer_number", "customer_name", "segment",
                         "new_name", "new_segment")


def apply_scd1(customers: DataFrame, changes: DataFrame) -> DataFrame:
    """Overwrite name and segment of the customers in ``changes``; everyone else is unchanged."""
    upd = changes.select("customer_id", "new_name", "new_segment", F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    return (customers.join(upd, "customer_id", "left")
            .select("customer_id", "customer_number",
                    F.when(hit, F.col("new_name")).otherwise(F.col("customer_name"))
                    .alias("customer_name"),
                    F.when(hit, F.col("new_segment")).otherwise(F.col("segment")).alias("segment")))


def new_customers(customers: DataFrame, delta: DataFrame, start: DataFrame | int | None = None) -> DataFrame:
    """Customers of the batch not yet known (first wins per number), ids after ``start`` (default: the
    maximum of ``customers``)."""
    fresh = first_wins(_stage_customers(delta), ["customer_number"])
    fresh = fresh.join(customers.select("customer_number"), "customer_number", "left_anti")
    start = _max_of(customers, "customer_id") if start is None else start
    return assign_dense_keys(fresh, "customer_id", asc_last("customer_number"), start=start).select(*CUSTOMERS)


def scd1_customers(customers: DataFrame, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SCD type 1: overwrite changed name/segment, then add unseen customers."""
    changes = scd1_changes(customers, delta)
    updated = apply_scd1(customers, changes)
    return updated.unionByName(new_customers(customers, delta)), changes


def _version_rows(delta: DataFrame, customers: DataFrame,
                  only_new_version: bool) -> tuple[DataFrame, DataFrame]:
    rows = delta
    if only_new_version:
        rows = rows.filter(F.col("is_new_version"))
    rows = rows.select(F.col("customer_id").alias("customer_number"), *ADDRESS_ATTRS,
                       effective_from("valid_from", "order_date").alias("new_from"))
    return rows, _customer_ids(customers)


def scd2_close_candidates(addresses: DataFrame, customers: DataFrame,
                          delta: DataFrame) -> DataFrame:
    """Per current address that some new-version row contradicts (any of 5
    attributes IS DISTINCT FROM), the earliest such row's start date.

    No address × version pairs are formed. The batch's version rows are first
    reduced to one row per (customer, distinct address) with its earliest
    start; of those only each customer's two earliest are kept (a top-2 that
    Spark limits map-side). An address's earliest *differing* version is the
    first of the two unless that one has the address's own attributes, in
    which case it is the second; with no second there is nothing to close.
    """
    rows, ids = _version_rows(delta, customers, True)
    rows = rows.groupBy("customer_number", *ADDRESS_ATTRS).agg(F.min("new_from").alias("new_from"))
    w = Window.partitionBy("customer_number").orderBy(F.col("new_from").asc_nulls_last(),
                                                      *asc_last(*ADDRESS_ATTRS))
    top2 = (rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 2)
            .join(ids, "customer_number"))
    first = top2.filter(F.col("_rn") == 1).select(
        F.col("customer_id").alias("_c1"), F.col("new_from").alias("_d1"),
        *[F.col(c).alias(f"_1{c}") for c in CLOSE_ATTRS])
    second = top2.filter(F.col("_rn") == 2).select(
        F.col("customer_id").alias("_c2"), F.col("new_from").alias("_d2"),
        F.lit(True).alias("_has2"))
    cur = addresses.filter(F.col("is_current"))
    j = (cur.join(first, F.col("customer_id") == F.col("_c1"))
         .join(second, F.col("customer_id") == F.col("_c2"), "left"))
    same_as_first = not_distinct_all([(F.col(c), F.col(f"_1{c}")) for c in CLOSE_ATTRS])
    return (j.filter(~same_as_first | F.col("_has2").isNotNull())
            .select("address_id", F.col("valid_from").alias("old_from"),
                    F.when(same_as_first, F.col("_d2")).otherwise(F.col("_d1")).alias("new_from")))


def scd2_closings(addresses: DataFrame, customers: DataFrame, delta: DataFrame) -> DataFrame:
    """``address_id, valid_to`` of the versions to end: the day before the new one starts; if that is
    not after the old start, on the old start."""
    cand = scd2_close_candidates(addresses, customers, delta)
    day_before = F.date_sub("new_from", 1)
    return cand.select("address_id", F.when(day_before <= F.col("old_from"), F.col("old_from"))
                       .otherwise(day_before).alias("valid_to"))


def apply_closings(addresses: DataFrame, closings: DataFrame) -> DataFrame:
    """End the versions named in ``closings``; all others are unchanged."""
    closing = closings.select("address_id", F.lit(True).alias("_close"), F.col("valid_to").alias("_to"))
    hit = F.col("_close").isNotNull()
    return (addresses.join(closing, "address_id", "left")
            .withColumn("valid_to", F.when(hit, F.col("_to")).otherwise(F.col("valid_to")))
            .withColumn("is_current", F.when(hit, F.lit(False)).otherwise(F.col("is_current")))
            .select(*ADDRESSES))


def scd2_close_versions(addresses: DataFrame, customers: DataFrame,
                        delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SCD type 2, step A: end contradicted current versions."""
    closings = scd2_closings(addresses, customers, delta)
    return apply_closings(addresses, closings), closings


def scd2_new_versions(addresses: DataFrame, customers: DataFrame, delta: DataFrame,
                      start: DataFrame | int | None = None) -> DataFrame:
    """SCD type 2, step B: batch addresses with no matching *current* version
    (4 attributes, null-safe; the version flag is not consulted). Ids follow
    ``start`` (default: the maximum of ``addresses``)."""
    rows, ids = _version_rows(delta, customers, False)
    rows = (rows.withColumnRenamed("new_from", "valid_from").distinct()
            .join(ids, "customer_number")
            .select("customer_id", *ADDRESS_ATTRS, "valid_from"))
    cur = addresses.filter(F.col("is_current")).select("customer_id", *INSERT_MATCH_ATTRS).alias("a")
    r = rows.alias("r")
    cond = F.col("r.customer_id") == F.col("a.customer_id")
    for c in INSERT_MATCH_ATTRS:
        cond = cond & F.col(f"r.{c}").eqNullSafe(F.col(f"a.{c}"))
    fresh = r.join(cur, cond, "left_anti")
    start = _max_of(addresses, "address_id") if start is None else start
    keyed = assign_dense_keys(fresh, "address_id", asc_last(*ADDRESS_ORDER), start=start)
    return (keyed.withColumn("valid_to", F.lit(None).cast("date"))
            .withColumn("is_current", F.lit(True)).select(*ADDRESSES))


def scd2_addresses(addresses: DataFrame, customers: DataFrame,
                   delta: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """SCD type 2 step: close contradicted versions, then insert new current ones (reads the closed
    state)."""
    closed, closing = scd2_close_versions(addresses, customers, delta)
    fresh = scd2_new_versions(closed, customers, delta)
    return closed.unionByName(fresh), closing, fresh


def secondary_products(products: DataFrame, delta: DataFrame) -> DataFrame:
    """Products of the batch not yet known (first wins), ids after the current maximum."""
    fresh = first_wins(_stage_products(delta), ["product_number"])
    fresh = fresh.join(products.select("product_number"), "product_number", "left_anti")
    return assign_dense_keys(fresh, "product_id", asc_last("product_number"),
                             start=_max_of(products, "product_id")).select(*PRODUCTS)


def secondary_orders(orders: DataFrame, customers: DataFrame, delta: DataFrame) -> DataFrame:
    """New order headers of the batch (ship date repaired), insert-if-absent."""
    fresh = _order_rows(delta, customers, repair=True)
    fresh = fresh.join(orders.select("order_number"), "order_number", "left_anti")
    fresh = first_wins(fresh, ["order_number"])
    keyed = assign_dense_keys(fresh, "order_id", asc_last("order_number"),
                              start=_max_of(orders, "order_id"))
    return keyed.crossJoin(next_batch_id(orders)).select(*ORDERS)


def new_detail_rows(details: DataFrame, orders: DataFrame, products: DataFrame,
                    delta: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Batch lines whose (order, product) pair is not in the old detail table
    (NOT EXISTS as a left anti join)."""
    rows = _detail_rows(delta, orders, products, quantity=repair_quantity("quantity"), carry=carry)
    # Only history of the batch's own orders can match. The semi join is what a
    # runtime filter can push into the history scan; an anti join is not.
    seen = (details.select("order_id", "product_id")
            .join(rows.select("order_id").distinct(), "order_id", "left_semi"))
    return rows.join(seen, ["order_id", "product_id"], "left_anti")


def secondary_order_details(details: DataFrame, orders: DataFrame, products: DataFrame, delta: DataFrame,
                            start: DataFrame | int | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Batch lines (quantity 0 → 1) for (order, product) pairs not loaded before.
    Pairs repeated inside the batch are all inserted (the check sees the old
    table only). Ids follow ``start`` (default: the maximum of ``details``)."""
    fresh = new_detail_rows(details, orders, products, delta, carry)
    start = _max_of(details, "order_detail_id") if start is None else start
    return assign_dense_keys(fresh, "order_detail_id", asc_last(*DETAIL_ORDER), start=start).select(*ORDER_DETAILS, *carry)


def secondary_load(state: CoreState, delta: DataFrame) -> CoreState:
    """The incremental load (M6–M12) in statement order; each step reads the previous step's
    frames."""
    customers, scd1 = scd1_customers(state.customers, delta)
    addresses, closing, _ = scd2_addresses(state.addresses, customers, delta)
    new_products = secondary_products(state.products, delta)
    products = state.products.unionByName(new_products)
    new_orders = secondary_orders(state.orders, customers, delta)
    orders = state.orders.unionByName(new_orders)
    new_details = secondary_order_details(state.order_details, orders, products, delta)
    return CoreState(customers=customers, addresses=addresses, products=products, orders=orders,
                     order_details=state.order_details.unionByName(new_details),
                     counters={"scd1": scd1, "closed": closing, "orders": new_orders,
                               "details": new_details})


# ---------------------------------------------------------------- correction

@dataclass(frozen=True)
class Correction:
    """Parameters of a period correction: inclusive date range, order-number
    prefix, and the percentage of lines kept."""
    start: dt.date
    end: dt.date
    prefix: str
    keep_percent: int


def correction_targets(orders: DataFrame, fix: Correction) -> DataFrame:
    """Order ids of the period whose number starts with the prefix."""
    in_period = F.col("order_date").between(F.lit(fix.start), F.lit(fix.end))
    return orders.filter(in_period & F.col("order_number").startswith(fix.prefix)).select("order_id")


def correct_period(orders: DataFrame, details: DataFrame,
                   fix: Correction) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Thin generated lines of a period to ``keep_percent`` (deterministic md5
    bucket of the line id), then drop every line-less order of the period."""
    in_period = F.col("order_date").between(F.lit(fix.start), F.lit(fix.end))
    period = orders.filter(in_period).select(
        "order_id", F.col("order_number").startswith(fix.prefix).alias("_target"))
    # One pass over the period's lines gives the lines to drop and the orders that keep one.
    lines = (details.select("order_id", "order_detail_id").join(period, "order_id")
             .withColumn("_doomed", F.col("_target")
                         & (md5_bucket("order_detail_id") >= fix.keep_percent)))
    doomed = lines.filter("_doomed").select("order_detail_id")
    kept = details.join(doomed, "order_detail_id", "left_anti")
    orphans = (period.select("order_id")
               .join(lines.filter("not _doomed").select("order_id"), "order_id", "left_anti"))
    return orders.join(orphans, "order_id", "left_anti"), kept, doomed, orphans
