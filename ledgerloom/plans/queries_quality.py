"""Registered data-quality queries (declared constraints as violation counts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import guard
from ledgerloom.operators import quality as q
from ledgerloom.plans.registry import register
from ledgerloom.plans.warehouse_run import warehouse as W
from ledgerloom.schemas import FOREIGN_KEYS, LENGTHS, NOT_NULL, UNIQUE

# Stage, final core and audit tables as oracle CTEs.
CORE = {"customers": "x_c2", "addresses": "x_a4", "products": "x_p2", "orders": "x_o2",
        "order_details": "x_d2", "load_audit": "x_audit_log", "raw_orders": "raw_orders",
        "delta_orders": "delta_orders"}


def _row(rule, table, column, expr, src):
    return (f"select '{rule}' as rule, '{table}' as table_name, '{column}' as column_name, "
            f"cast({expr} as bigint) as violations from {src}")


NOT_NULL_SQL = " union all ".join(
    _row("not_null", t, c, f"count(*) filter (where {c} is null)", CORE[t])
    for t, cols in NOT_NULL.items() for c in cols)
UNIQUE_SQL = " union all ".join(
    _row("unique", t, k, f"count(*) - count(distinct {k})", CORE[t])
    for t, keys in UNIQUE.items() for k in keys)
FK_SQL = " union all ".join(
    _row("foreign_key", child, col, "count(*)",
         f"{CORE[child]} x where not exists (select 1 from {CORE[parent]} p where p.{pcol} = x.{col})")
    for child, col, parent, pcol in FOREIGN_KEYS)
CHECK_DATES_SQL = _row("check_dates", "addresses", "valid_to",
                       "count(*) filter (where valid_to is not null and valid_to <= valid_from)", "x_a4")
SHIP_SQL = _row("check_order_dates", "orders", "ship_date",
                "count(*) filter (where ship_date < order_date)", "x_o2")
QTY_SQL = _row("check_quantity", "order_details", "quantity",
               "count(*) filter (where quantity <= 0)", "x_d2")
DISCOUNT_SQL = _row("check_discount", "order_details", "discount",
                    "count(*) filter (where discount < 0 or discount > 1)", "x_d2")
LENGTHS_SQL = " union all ".join(
    _row("varchar_length", t, c, f"count(*) filter (where length({c}) > {n})", CORE[t])
    for t, limits in LENGTHS.items() for c, n in limits.items())
ONE_CURRENT_SQL = _row("one_current_address", "addresses", "customer_id",
                       "count(*) filter (where n > 1)",
                       "(select customer_id, count(*) filter (where is_current) as n from x_a4 group by customer_id) t")
FANOUT_SRC = """(select d.order_detail_id, m.matches from x_d2 d join (
    select o.order_id, count(a.address_id) as matches from x_o2 o
    left join x_a4 a on o.customer_id = a.customer_id and o.order_date >= a.valid_from
                     and (a.valid_to is null or o.order_date <= a.valid_to)
    group by o.order_id) m on d.order_id = m.order_id) t"""
FANOUT_SQL = (_row("fact_fanout", "fact_sales", "no_version", "count(*) filter (where matches = 0)", FANOUT_SRC)
              + " union all "
              + _row("fact_fanout", "fact_sales", "several_versions", "count(*) filter (where matches > 1)", FANOUT_SRC))


def _tables(spark, sf):
    w = W(spark, sf)
    return {**w.final().tables(), "load_audit": w.audit_log(), "raw_orders": w.raw_orders(),
            "delta_orders": w.delta_orders()}


@register("dq_not_null", NOT_NULL_SQL)
def dq_not_null(spark, sf):
    """NOT NULL columns."""
    return q.dq_not_null(_tables(spark, sf))


@register("dq_unique", UNIQUE_SQL)
def dq_unique(spark, sf):
    """UNIQUE / PRIMARY KEY columns."""
    return q.dq_unique(_tables(spark, sf))


@register("dq_foreign_keys", FK_SQL)
def dq_foreign_keys(spark, sf):
    """D3: FOREIGN KEY references (orphans via left anti joins)."""
    return q.dq_foreign_keys(_tables(spark, sf))


@register("dq_check_dates", CHECK_DATES_SQL)
def dq_check_dates(spark, sf):
    """CHECK valid_to > valid_from."""
    return q.dq_check_dates(_tables(spark, sf)["addresses"])


@register("dq_ship_after_order", SHIP_SQL)
def dq_ship_after_order(spark, sf):
    """CHECK ship_date >= order_date."""
    return q.dq_ship_after_order(_tables(spark, sf)["orders"])


@register("dq_quantity", QTY_SQL)
def dq_quantity(spark, sf):
    """CHECK quantity > 0."""
    return q.dq_quantity(_tables(spark, sf)["order_details"])


@register("dq_discount", DISCOUNT_SQL)
def dq_discount(spark, sf):
    """CHECK 0 <= discount <= 1."""
    return q.dq_discount(_tables(spark, sf)["order_details"])


@register("dq_lengths", LENGTHS_SQL)
def dq_lengths(spark, sf):
    """VARCHAR(n) limits of the stage, core and audit tables."""
    return q.dq_lengths(_tables(spark, sf))


@register("dq_one_current_address", ONE_CURRENT_SQL)
def dq_one_current_address(spark, sf):
    """Customers with more than one current address."""
    return q.dq_one_current_address(_tables(spark, sf)["addresses"])


@register("dq_fact_fanout", FANOUT_SQL)
def dq_fact_fanout(spark, sf):
    """Lines matching no or several address versions."""
    t = _tables(spark, sf)
    return q.dq_fact_fanout(t["order_details"], t["orders"], t["addresses"])


@register("dq_report", " union all ".join([
    NOT_NULL_SQL, UNIQUE_SQL, FK_SQL, CHECK_DATES_SQL, SHIP_SQL, QTY_SQL, DISCOUNT_SQL, LENGTHS_SQL,
    ONE_CURRENT_SQL, FANOUT_SQL]))
def dq_report(spark, sf):
    """All rules in one report."""
    return q.dq_report(_tables(spark, sf))


# The id of a row in the table of rejects.
IDS = {"customers": "customer_id", "addresses": "address_id", "products": "product_id",
       "orders": "order_id", "order_details": "order_detail_id"}
CHECK_SQL = {
    "addresses": [("check_dates", "valid_to", "valid_to <= valid_from")],
    "orders": [("check_order_dates", "ship_date", "ship_date < order_date")],
    "order_details": [("check_quantity", "quantity", "quantity <= 0"),
                      ("check_discount", "discount", "discount < 0 or discount > 1")],
}


def _reject_sql(table: str) -> str:
    rules = [(f"not_null:{c}", f"{c} is null") for c in NOT_NULL[table]]
    rules += [(f"{r}:{c}", bad) for r, c, bad in CHECK_SQL.get(table, [])]
    rules += [(f"varchar_length:{c}", f"length({c}) > {n}") for c, n in LENGTHS.get(table, {}).items()]
    rules += [(f"unique:{k}", f"{k} is null or row_number() over (partition by {k}) > 1") for k in UNIQUE[table]]
    rules += [(f"foreign_key:{c}", f"{c} is not null and {c} not in (select {pc} from {CORE[p]})")
              for t, c, p, pc in FOREIGN_KEYS if t == table]
    reasons = ", ".join(f"case when {bad} then '{name}' end" for name, bad in rules)
    return (f"select '{table}' as table_name, cast({IDS[table]} as bigint) as id, reasons "
            f"from (select {IDS[table]}, concat_ws(',', {reasons}) as reasons from {CORE[table]}) t where reasons <> ''")


@register("guarded_rejects", " union all ".join(map(_reject_sql, IDS)))
def guarded_rejects(spark, sf):
    """D1–D8 at write time: the rows that a guarded write parts from the good ones, with their reasons."""
    return guard.reject_report(W(spark, sf).final().tables(), IDS)


@register("load_reconciliation", """
select (select cast(count(*) as bigint) from raw_orders) as stage_rows,
       (select cast(count(*) as bigint) from x_c1) as customers_rows,
       (select cast(count(*) as bigint) from x_a1) as addresses_rows,
       (select cast(count(*) as bigint) from x_p1) as products_rows,
       (select cast(count(*) as bigint) from x_o1) as orders_rows,
       (select cast(count(*) as bigint) from x_d1) as order_details_rows""")
def load_reconciliation(spark, sf):
    """Row counts after the initial load."""
    w = W(spark, sf)
    return q.load_reconciliation(w.raw_orders(), w.initial().tables())


@register("apply_defaults", """
select 'order_details' as table_name, cast(order_detail_id as bigint) as id, cast(coalesce(discount, 0) as double) as discount,
       cast(null as boolean) as is_current from x_d2
union all select 'addresses', cast(address_id as bigint), null, coalesce(is_current, true) from x_a4""")
def apply_defaults(spark, sf):
    """DDL defaults applied to NULLs (discount 0.00, is_current TRUE)."""
    t = _tables(spark, sf)
    details, addresses = q.apply_defaults(t["order_details"], t["addresses"])
    return (details.select(F.lit("order_details").alias("table_name"), F.col("order_detail_id").alias("id"),
                           "discount", F.lit(None).cast("boolean").alias("is_current"))
            .unionByName(addresses.select(F.lit("addresses").alias("table_name"), F.col("address_id").alias("id"),
                                          F.lit(None).cast("decimal(5,2)").alias("discount"), "is_current")))
