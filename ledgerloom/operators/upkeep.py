"""Incremental upkeep of the core tables at the cost of the batch, not of the tables.

Customers and addresses change in place. They are kept as one folder per
bucket of their customer, and a load rewrites only the buckets in which a row
changes or is new: the other folders are named again by the next state, as
they are. The batch names its customers, so only their buckets are read to
find the changes. Products, orders and order lines only grow; a load adds one
part with the new rows, and orders and their lines one a year of order, so that
a correction of a period rewrites its years only. Of the order lines, which are
most of the warehouse, a load reads only the parts that can hold an order of
the batch: an index of their order ids is kept beside them. Small parts are
merged with others of their size, so their number grows with the logarithm of
the rows and not with the loads.

``incremental_load`` is the one statement of the load's order; batch runs and
the stream give it a store that decides where folders go.
"""

from __future__ import annotations

import contextvars
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import mart
from ledgerloom.operators import warehouse as wh
from ledgerloom.schemas import CORE
from ledgerloom.sources import part_index

Parts = dict[str, list[str]]
# What a bucket is taken from: all rows that one statement joins lie in one bucket.
BUCKET_KEYS = {"customers": "customer_number", "addresses": "customer_id"}
BUCKET = "_bucket"
# Tables whose parts are cut by the year of order.
YEAR, BY_YEAR = "_year", ("orders", "order_details")
MERGED = 8      # parts of one size that are merged into one
# Index folders of the order lines' parts, named in a state beside its tables.
LINE_INDEX, LINE_KEYS = "order_details_index", ("order_id",)


class Store(Protocol):
    """Where a load reads its tables and writes its folders."""
    spark: SparkSession
    buckets: int

    def write(self, name: str, build: Callable[[], DataFrame], partition_by: str | None = None) -> str:
        """Write what ``build`` gives under a name of this load, unless that is done; returns the folder."""
        ...

    def rows(self, path: str) -> int:
        """Rows of a folder that ``write`` returned."""
        ...

    def folders(self, path: str) -> list[str]:
        """The sub-folders of a partitioned folder."""
        ...


# ------------------------------------------------------------------ buckets

def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def bucket_number(path: str) -> int:
    return int(path.rstrip("/").rsplit(f"{BUCKET}=", 1)[1])


def in_buckets(frames: Iterable[DataFrame], key: str, buckets: int) -> set[int]:
    """Buckets that hold a key of any of the frames (at most one row a bucket comes back)."""
    found = None
    for f in frames:
        own = f.select(bucket_of(key, buckets).alias(BUCKET)).distinct()
        found = own if found is None else found.union(own)
    return {r[0] for r in found.distinct().collect()}


def partition_folders(path: str, names: Iterable[str]) -> list[str]:
    """The folders of a partitioned write among the names under its path, buckets in order of number."""
    found = [f"{path}/{n}" for n in names if n.startswith((f"{BUCKET}=", f"{YEAR}="))]
    return sorted(found, key=lambda p: (bucket_number(p) if f"{BUCKET}=" in p else 0, p))


def of_buckets(paths: list[str], wanted: set[int]) -> list[str]:
    return [p for p in paths if bucket_number(p) in wanted]


def with_buckets(paths: list[str], rewritten: list[str]) -> list[str]:
    """The state's folders after some buckets were rewritten."""
    now = {bucket_number(p): p for p in paths} | {bucket_number(p): p for p in rewritten}
    return [now[b] for b in sorted(now)]


def read(spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
    """A core table from its folders (an empty one from none)."""
    if not paths:
        return spark.createDataFrame([], CORE[table])
    return spark.read.schema(CORE[table]).parquet(*paths)


def write_buckets(store: Store, name: str, table: str, build: Callable[[], DataFrame]) -> list[str]:
    """Write rows of ``table`` as one folder a bucket; large buckets in several files."""
    def spread() -> DataFrame:
        return build().withColumn(BUCKET, bucket_of(BUCKET_KEYS[table], store.buckets)).hint("rebalance", BUCKET)
    return store.folders(store.write(name, spread, BUCKET))


def with_year(orders: DataFrame) -> DataFrame:
    return orders.withColumn(YEAR, F.year("order_date"))


def part_year(path: str) -> int | None:
    """The year of a part's orders; None for those without a date and for parts not cut by year."""
    name = path.rstrip("/").rsplit("/", 1)[1]
    return int(name[len(YEAR) + 1:]) if name.startswith(f"{YEAR}=") and name[len(YEAR) + 1:].isdigit() else None


def write_years(store: Store, name: str, build: Callable[[], DataFrame]) -> list[str]:
    """Write rows that carry ``_year`` as one folder a year; returns the folders (none: no rows).

    Years are few, so each task writes to its own rows' years and nothing is shuffled for it.
    """
    return store.folders(store.write(name, build, YEAR))


def write_index(store: Store, step: str, paths: list[str]) -> str:
    """Index the parts of one load's order lines; returns the index's folder."""
    def build() -> DataFrame:
        rows = None
        for p in paths:
            own = read(store.spark, "order_details", [p]).select(*LINE_KEYS, F.lit(p).alias("path"))
            rows = own if rows is None else rows.unionByName(own)
        if rows is None:
            return part_index.read_index(store.spark, [])
        return part_index.index_parts(rows, LINE_KEYS, max(store.rows(p) for p in paths))
    return store.write(f"{step}/{LINE_INDEX}", build)


def lines_of(spark: SparkSession, parts: Parts, orders: DataFrame) -> list[str]:
    """Parts of the order lines that can hold a line of ``orders`` (order_id); unindexed parts always can."""
    folders = parts.get(LINE_INDEX, [])
    if not folders:
        return list(parts["order_details"])
    index = part_index.read_index(spark, folders)
    indexed = {r["path"] for r in index.select("path").distinct().collect()}      # one row a part
    hit = set(part_index.parts_with(index, orders, "order_id"))
    return [p for p in parts["order_details"] if p not in indexed or p in hit]


def first_state(store: Store, step: str, state: wh.CoreState) -> Parts:
    """Write whole tables as the folders that the first incremental load starts from."""
    parts: Parts = {}
    dated = with_year(state.orders)
    frames = {**state.tables(), "orders": dated,
              "order_details": state.order_details.join(dated.select("order_id", YEAR), "order_id", "left")}
    for table, df in frames.items():
        if table in BUCKET_KEYS:
            parts[table] = write_buckets(store, f"{step}/{table}", table, lambda df=df: df)
        elif table in BY_YEAR:
            parts[table] = write_years(store, f"{step}/{table}", lambda df=df: df)
        else:
            parts[table] = [store.write(f"{step}/{table}", lambda df=df: df)]
    return {**parts, LINE_INDEX: [write_index(store, step, parts["order_details"])]}


# --------------------------------------------------------------- compaction

def _tier(rows: int) -> int:
    tier = 0
    while rows >= MERGED:
        rows //= MERGED
        tier += 1
    return tier


def compact(store: Store, step: str, parts: Parts) -> Parts:
    """Merge small parts of the growing tables: of one year and size class, ``MERGED`` become one.

    A merged part is of a higher class, so a table has less than ``MERGED`` parts of a year in
    each class and its classes are the logarithm of its rows. Readers of the state before keep theirs.
    """
    out = {t: list(p) for t, p in parts.items()}
    for table in ("products", *BY_YEAR):
        turn = 0
        while True:
            groups: dict[tuple, list[str]] = {}
            for p in out[table]:
                groups.setdefault((part_year(p), _tier(store.rows(p))), []).append(p)
            full = [(k, g) for k, g in groups.items() if len(g) >= MERGED]
            if not full:
                break
            for (year, tier), group in full:
                name = f"{step}/merged/{table}-{turn}-{tier}/{YEAR}={year}" if year is not None else f"{step}/merged/{table}-{turn}-{tier}"
                path = store.write(name, lambda g=group: read(store.spark, table, g))
                out[table] = [p for p in out[table] if p not in group] + [path]
            turn += 1
    if LINE_INDEX in out and out["order_details"] != parts["order_details"]:
        merged = [p for p in out["order_details"] if p not in parts["order_details"]]
        index = part_index.read_index(store.spark, out[LINE_INDEX])
        kept = [p for p in out["order_details"] if p in parts["order_details"]]
        # One index of all parts takes the place of the loads' own.
        names = store.spark.createDataFrame([(p,) for p in kept], "path string")
        fresh = [read(store.spark, "order_details", [p]).select(*LINE_KEYS, F.lit(p).alias("path")) for p in merged]
        rows = reduce(DataFrame.unionByName, fresh)
        out[LINE_INDEX] = [store.write(f"{step}/merged/{LINE_INDEX}", lambda: index.join(names, "path", "left_semi").unionByName(
            part_index.index_parts(rows, LINE_KEYS, max(store.rows(p) for p in merged))))]
    return out


# -------------------------------------------------------------------- loads

def clean_up(store: Store, step: str, paths: list[str]) -> list[str]:
    """M14 on the buckets of customers with several current addresses; returns the table's folders."""
    addresses = read(store.spark, "addresses", paths)
    several = addresses.where("is_current").groupBy("customer_id").agg(F.count("*").alias("n")).where("n > 1")
    touched = in_buckets([several], "customer_id", store.buckets)
    if not touched:
        return paths
    return with_buckets(paths, write_buckets(
        store, f"{step}/addresses", "addresses",
        lambda: wh.cleanup_addresses(read(store.spark, "addresses", of_buckets(paths, touched)))))


def _parallel(*jobs):
    """Run independent jobs side by side, each in a copy of the caller's context."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(contextvars.copy_context().run, job) for job in jobs]
        return [f.result() for f in futures]


def _largest(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.max(key).alias("_m"))


def incremental_load(store: Store, step: str, before: Parts, delta: DataFrame) -> tuple[Parts, dict[str, int]]:
    """The incremental load on the tables in ``before``: the folders after it, and its row counts.

    Each statement reads the written result of the one before: products
    alongside customers (SCD 1), then addresses (SCD 2) alongside orders and
    their lines. Counts are those of the folders written.
    """
    spark = store.spark
    parts = {t: list(p) for t, p in before.items()}
    counts: dict[str, int] = {}
    fresh: Parts = {}

    def change_set(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = store.write(f"{step}/changes/{name}", build)
        counts[name] = store.rows(path)
        return spark.read.parquet(path)

    def append(table: str, build: Callable[[], DataFrame]) -> DataFrame:
        name = f"{step}/{table}"
        path = store.write(name, build, YEAR if table in BY_YEAR else None)
        counts[table] = store.rows(path)
        fresh[table] = store.folders(path) if table in BY_YEAR else [path]
        parts[table] = before[table] + fresh[table]
        return read(spark, table, parts[table])

    def rewrite(table: str, touched: set[int], change: Callable[[DataFrame], DataFrame]) -> None:
        if touched:
            old = of_buckets(before[table], touched)
            parts[table] = with_buckets(before[table], write_buckets(
                store, f"{step}/{table}", table, lambda: change(read(spark, table, old))))

    # The customers that the batch names, old and new: nothing else is read or written.
    named = delta.select(F.col("customer_id").alias("customer_number"))
    asked = in_buckets([named], "customer_number", store.buckets)

    def customers() -> None:
        known = read(spark, "customers", of_buckets(before["customers"], asked))
        last = _largest(read(spark, "customers", before["customers"]), "customer_id")
        changes, unseen = _parallel(
            lambda: change_set("scd1", lambda: wh.scd1_changes(known, delta)),
            lambda: change_set("new_customers", lambda: wh.new_customers(known, delta, start=last)))
        touched = in_buckets([changes, unseen], "customer_number", store.buckets)
        rewrite("customers", touched, lambda rows: wh.apply_scd1(rows, changes).unionByName(unseen))

    def addresses() -> None:
        ids = batch_customers.select("customer_id")
        here = in_buckets([ids], "customer_id", store.buckets)
        known = read(spark, "addresses", of_buckets(before["addresses"], here))
        last = _largest(read(spark, "addresses", before["addresses"]), "address_id")
        owner = known.select("address_id", "customer_id")
        closing = change_set("closed", lambda: wh.scd2_closings(known, batch_customers, delta).join(owner, "address_id"))
        closed = wh.apply_closings(known, closing)
        begun = change_set("new_versions", lambda: wh.scd2_new_versions(closed, batch_customers, delta, start=last))
        touched = in_buckets([closing, begun], "customer_id", store.buckets)
        rewrite("addresses", touched, lambda rows: wh.apply_closings(rows, closing).unionByName(begun))

    def orders_and_lines() -> None:
        known_orders = read(spark, "orders", before["orders"])
        orders = append("orders", lambda: with_year(wh.secondary_orders(known_orders, batch_customers, delta)))
        numbers = delta.select(F.col("order_id").alias("order_number")).distinct()
        asked_orders = with_year(orders).join(numbers, "order_number", "left_semi")
        seen = read(spark, "order_details", lines_of(spark, before, asked_orders.select("order_id")))
        last = _largest(read(spark, "order_details", before["order_details"]), "order_detail_id")
        append("order_details", lambda: wh.secondary_order_details(
            seen, asked_orders, products, delta, start=last, carry=[YEAR]))
        if fresh["order_details"]:
            parts[LINE_INDEX] = [*before.get(LINE_INDEX, []), write_index(store, step, fresh["order_details"])]

    known_products = read(spark, "products", before["products"])
    _, products = _parallel(
        customers, lambda: append("products", lambda: wh.secondary_products(known_products, delta)))
    batch_customers = read(spark, "customers", of_buckets(parts["customers"], asked)).join(
        named.distinct(), "customer_number", "left_semi")
    _parallel(addresses, orders_and_lines)
    return parts, counts


# --------------------------------------------------------------------- mart

FACT = "fact_sales"


def fact_years(spark: SparkSession, before: Parts, after: Parts) -> set[int]:
    """Years of the fact that differ between two states, from the folders in which they differ.

    New orders and lines are in folders of their year. An address version that
    ended or began may change its customer's orders from that day on; only the
    rewritten buckets are compared (at most one row a year comes back).
    """
    years = {part_year(p) for t in BY_YEAR for p in after[t] if p not in before[t]}
    moved = {bucket_number(p) for p in after["addresses"] if p not in before["addresses"]}
    if moved:
        old, new = (read(spark, "addresses", of_buckets(parts["addresses"], moved)) for parts in (before, after))
        since = (new.exceptAll(old).groupBy("customer_id")
                 .agg(F.min(F.coalesce("valid_to", "valid_from")).alias("since")))
        orders = read(spark, "orders", after["orders"]).select("customer_id", "order_date")
        hit = orders.join(since, "customer_id").where(F.col("order_date") >= F.col("since"))
        years |= {r[0] for r in hit.select(F.year("order_date")).distinct().collect()}
    return {y for y in years if y is not None}


def write_fact(store: Store, step: str, parts: Parts, years: set[int] | None = None) -> list[str]:
    """The point-in-time fact, one folder a year of order; with ``years`` only those are made anew."""
    known = parts.get(FACT, [])
    if years is not None and not years:
        return known
    wanted = {t: [p for p in parts[t] if years is None or part_year(p) in years] for t in BY_YEAR}
    folders = write_years(store, f"{step}/{FACT}", lambda: with_year(mart.fact_sales(
        read(store.spark, "order_details", wanted["order_details"]), read(store.spark, "orders", wanted["orders"]),
        read(store.spark, "addresses", parts["addresses"]))))
    now = {part_year(p): p for p in known} | {part_year(p): p for p in folders}
    return [now[y] for y in sorted(now, key=lambda y: (y is not None, y or 0))]


def read_fact(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.parquet(*paths)
