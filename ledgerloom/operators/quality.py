"""Declared constraints re-aimed as violation counts.

Postgres rejects a bad row at insert time; here every rule is one set-based
query returning ``(rule, table_name, column_name, violations)`` so a whole
load can be checked at once and the rules can be unioned into one report.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.guard import row_checks
from ledgerloom.schemas import FOREIGN_KEYS, LENGTHS, NOT_NULL, UNIQUE

RESULT = ["rule", "table_name", "column_name", "violations"]


def _one(df: DataFrame, rule: str, table: str, column: str, bad: Column) -> DataFrame:
    return df.agg(F.count_if(bad).cast("long").alias("violations")).select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"), "violations")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _per_column(df: DataFrame, rule: str, table: str, checks: Mapping[str, Column]) -> DataFrame:
    """Several column checks of one table in a single aggregate pass."""
    agg = df.agg(*[F.count_if(bad).cast("long").alias(c) for c, bad in checks.items()])
    return (agg.unpivot([], list(checks), "column_name", "violations")
            .select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                    "column_name", "violations"))


def dq_not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs in NOT NULL columns, one aggregate pass per table."""
    return _union([_per_column(tables[t], "not_null", t, {c: F.col(c).isNull() for c in cols})
                   for t, cols in NOT_NULL.items()])


def dq_unique(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows beyond the first for each key value (a NULL key counts as one such
    row). Each table is scanned once for all its keys, and all keys of all
    tables are counted by one grouping, combined before the shuffle."""
    named = [(t, k) for t, keys in UNIQUE.items() for k in keys]
    number = {n: i for i, n in enumerate(named)}           # a key's number is moved with its values, not its name
    values = [tables[t].select(F.explode(F.array(*[
        F.struct(F.lit(number[t, k]).alias("_key"), F.col(k).cast("string").alias("_k")) for k in keys])).alias("x")).select("x.*")
        for t, keys in UNIQUE.items()]
    per = _union(values).groupBy("_key", "_k").agg(F.count(F.lit(1)).alias("_n"))
    beyond = per.groupBy("_key").agg(F.sum(
        F.when(F.col("_k").isNull(), F.col("_n")).otherwise(F.col("_n") - 1)).alias("_v"))
    spark = next(iter(tables.values())).sparkSession
    every = spark.range(len(named)).select(F.col("id").cast("int").alias("_key"), F.lit(0).cast("long").alias("_v"))
    table, column = (F.element_at(F.array(*[F.lit(n[i]) for n in named]), F.col("_key") + 1) for i in (0, 1))
    return (beyond.unionByName(every).groupBy("_key").agg(F.sum("_v").alias("violations"))
            .select(F.lit("unique").alias("rule"), table.alias("table_name"), column.alias("column_name"), "violations"))


def dq_foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """D3: child rows whose key has no parent row (left anti joins)."""
    out = []
    for child, col, parent, pcol in FOREIGN_KEYS:
        orphans = tables[child].select(col).join(
            tables[parent].select(F.col(pcol).alias(col)), col, "left_anti")
        out.append(orphans.agg(F.count(F.lit(1)).cast("long").alias("violations")).select(
            F.lit("foreign_key").alias("rule"), F.lit(child).alias("table_name"),
            F.lit(col).alias("column_name"), "violations"))
    return _union(out)


def dq_check_dates(addresses: DataFrame) -> DataFrame:
    """Closed versions that do not end after they start."""
    bad = F.col("valid_to").isNotNull() & (F.col("valid_to") <= F.col("valid_from"))
    return _one(addresses, "check_dates", "addresses", "valid_to", bad)


def dq_ship_after_order(orders: DataFrame) -> DataFrame:
    """Orders shipped before they were placed."""
    return _one(orders, "check_order_dates", "orders", "ship_date",
                F.col("ship_date") < F.col("order_date"))


def dq_quantity(details: DataFrame) -> DataFrame:
    """Lines with a non-positive quantity."""
    return _one(details, "check_quantity", "order_details", "quantity", F.col("quantity") <= 0)


def dq_discount(details: DataFrame) -> DataFrame:
    """Discounts outside [0, 1]."""
    return _one(details, "check_discount", "order_details", "discount",
                (F.col("discount") < 0) | (F.col("discount") > 1))


def dq_lengths(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Texts longer than their VARCHAR limit, one pass per table."""
    return _union([_per_column(tables[t], "varchar_length", t,
                               {c: F.length(c) > n for c, n in limits.items()})
                   for t, limits in LENGTHS.items()])


def dq_one_current_address(addresses: DataFrame) -> DataFrame:
    """Customers with more than one current address."""
    per = addresses.groupBy("customer_id").agg(F.count_if(F.col("is_current")).alias("_n"))
    return _one(per, "one_current_address", "addresses", "customer_id", F.col("_n") > 1)


def fact_match_counts(details: DataFrame, orders: DataFrame, addresses: DataFrame) -> DataFrame:
    """Address versions matched by each order header (0 = no geography)."""
    from ledgerloom.operators.mart import orders_with_geography
    per_order = (orders_with_geography(orders, addresses).groupBy("order_id")
                 .agg(F.count("address_id").alias("matches")))
    return details.select("order_detail_id", "order_id").join(per_order, "order_id")


def dq_fact_fanout(details: DataFrame, orders: DataFrame, addresses: DataFrame) -> DataFrame:
    """Lines matching no address version, and lines matching several."""
    m = fact_match_counts(details, orders, addresses)
    return _per_column(m, "fact_fanout", "fact_sales",
                       {"no_version": F.col("matches") == 0,
                        "several_versions": F.col("matches") > 1})


def _table_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every single-row rule of a table (NOT NULL, CHECKs) evaluated in ONE
    aggregate pass per table, then unpivoted."""
    out = []
    for t, df in tables.items():
        named = []                       # (rule, column, aggregate expression)
        for c in NOT_NULL.get(t, []):
            named.append(("not_null", c, F.count_if(F.col(c).isNull())))
        for rule, c, bad in row_checks(t):
            named.append((rule, c, F.count_if(bad)))
        if not named:
            continue
        agg = df.agg(*[e.cast("long").alias(f"r{i}") for i, (_, _, e) in enumerate(named)])
        out.append(agg.select(F.explode(F.array(*[
            F.struct(F.lit(rule).alias("rule"), F.lit(t).alias("table_name"),
                     F.lit(c).alias("column_name"), F.col(f"r{i}").alias("violations"))
            for i, (rule, c, _) in enumerate(named)])).alias("x")).select("x.*"))
    return _union(out)


def dq_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rules in one report over the stage, core and audit tables: one pass
    per table for its own rules, one for the lengths, plus keys and the
    cross-table rules."""
    return _union([
        _table_rules(tables), dq_unique(tables), dq_foreign_keys(tables), dq_lengths(tables),
        dq_one_current_address(tables["addresses"]),
        dq_fact_fanout(tables["order_details"], tables["orders"], tables["addresses"]),
    ])


def load_reconciliation(stage: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts after a load, side by side (one row)."""
    counts = [stage.agg(F.count(F.lit(1)).alias("stage_rows"))]
    for t in ("customers", "addresses", "products", "orders", "order_details"):
        counts.append(tables[t].agg(F.count(F.lit(1)).alias(f"{t}_rows")))
    return reduce(lambda a, b: a.crossJoin(b), counts)


def apply_defaults(details: DataFrame, addresses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Column defaults of the DDL applied to NULLs: discount 0.00, is_current TRUE."""
    d = details.withColumn("discount", F.coalesce(F.col("discount"),
                                                  F.lit(0).cast("decimal(5,2)")))
    a = addresses.withColumn("is_current", F.coalesce(F.col("is_current"), F.lit(True)))
    return d, a
