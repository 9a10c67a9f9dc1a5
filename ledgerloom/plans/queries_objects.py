"""Registered queries over named objects: views, typed and intermediate tables, procedural blocks,
audit times, and the small expressions that have no query of their own elsewhere."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import columns as fc
from ledgerloom.operators import audit
from ledgerloom.operators import time_intelligence as ti
from ledgerloom.operators import warehouse as wh
from ledgerloom.plans.queries_core import FACT
from ledgerloom.plans.queries_reports import syoy
from ledgerloom.plans.queries_stage import DELTA_SQL, RAW_SQL
from ledgerloom.plans.queries_time import _calendar, _fact
from ledgerloom.plans.registry import register
from ledgerloom.plans.warehouse_run import TABLES, warehouse as W
from ledgerloom.schemas import CORE, DELTA_ORDERS, RAW_COLUMNS, RAW_ORDERS
from ledgerloom.session import scratch_folder
from ledgerloom.sources import catalog, files

SQL_OF = {"customers": "x_c2", "addresses": "x_a4", "products": "x_p2", "orders": "x_o2", "order_details": "x_d2"}


def _views(spark, sf) -> str:
    """Prefix of the views over this input's final state."""
    w = W(spark, sf)
    prefix = f"v{w.root.rstrip('/').rsplit('/', 1)[1].replace('-', '_')}_"
    catalog.create_views(spark, w.parts("secondary"), prefix)
    return prefix


@register("view_fact_sales", f"select {FACT} from x_fact")
def view_fact_sales(spark, sf):
    """The fact as a persisted SQL view over the core tables."""
    return spark.table(f"{_views(spark, sf)}fact_sales")


@register("view_dim_customers", """
select cast(customer_id as bigint) as customer_id, customer_number, customer_name, segment, country, city,
       state, region, cast(postal_code as bigint) as postal_code
from x_dim_customers""")
def view_dim_customers(spark, sf):
    """Customers with their newest current address, as a persisted SQL view."""
    return spark.table(f"{_views(spark, sf)}dim_customers")


@register("view_category_sales", """
select p.category, cast(sum(f.sales) as double) as total_sales, cast(count(*) as bigint) as lines
from x_fact f join x_dim_products p on f.product_id = p.product_id group by p.category""")
def view_category_sales(spark, sf):
    """SQL over two of the persisted views."""
    v = _views(spark, sf)
    return spark.sql(f"select p.category, sum(f.sales) as total_sales, count(*) as lines from {v}fact_sales f "
                     f"join {v}dim_products p on p.product_id = f.product_id group by p.category")


@register("scan_tables", " union all ".join(
    f"select '{t}' as table_name, cast(count(*) as bigint) as n from {s}"
    for t, s in {"raw_orders": "raw_orders", "delta_orders": "delta_orders", "fact_sales": "x_fact", **SQL_OF}.items()))
def scan_tables(spark, sf):
    """A scan of every stage, core and mart table."""
    w = W(spark, sf)
    tables = {"raw_orders": w.raw_orders(), "delta_orders": w.delta_orders(), "fact_sales": w.fact_sales(), **w.final().tables()}
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
                                          for t, df in tables.items()])


@register("typed_tables", " union all ".join(
    f"select '{t}' as table_name, cast(count(*) as bigint) as inserted, cast(0 as bigint) as truncated, "
    f"'{CORE[t].simpleString()}' as types from {s}" for t, s in SQL_OF.items()))
def typed_tables(spark, sf):
    """Each core table created with its declared types, filled, and truncated."""
    base, out = scratch_folder(spark, "typed"), []
    for t, df in W(spark, sf).final().tables().items():
        full = catalog.TypedTable(spark, f"{base}/{t}", CORE[t]).create().insert(df)
        empty = catalog.TypedTable(spark, f"{base}/{t}-truncated", CORE[t]).create().insert(df.limit(1)).truncate()
        out.append(full.read().agg(F.count(F.lit(1)).alias("inserted")).crossJoin(
            empty.read().agg(F.count(F.lit(1)).alias("truncated"))).select(
            F.lit(t).alias("table_name"), "inserted", "truncated", F.lit(full.read().schema.simpleString()).alias("types")))
    return reduce(DataFrame.unionByName, out)


@register("temp_table_closings", """
select cast(a.customer_id as bigint) as customer_id, cast(count(*) as bigint) as closed, cast(max(k.valid_to) as varchar) as last_end
from x_close_to k join x_a2 a on a.address_id = k.address_id group by a.customer_id""")
def temp_table_closings(spark, sf):
    """Versions to close, kept as an intermediate table that two statements read, then dropped."""
    w = W(spark, sf)
    result = f"{scratch_folder(spark, 'temp-result')}/closings"
    with catalog.temp_table(wh.scd2_closings(w.cleaned().addresses, w.secondary().customers, w.delta_orders()), "to_close") as closing:
        owners = w.cleaned().addresses.select("address_id", "customer_id").join(
            spark.table("to_close").select("address_id"), "address_id", "left_semi")
        (closing.join(owners, "address_id").groupBy("customer_id")
         .agg(F.count(F.lit(1)).alias("closed"), F.max("valid_to").alias("last_end")).write.parquet(result))
    return spark.read.parquet(result)


@register("src_csv_fallback", f"select {RAW_SQL} from raw_orders")
def src_csv_fallback(spark, sf):
    """A missing source file falls back to the frame in hand."""
    missing = f"{scratch_folder(spark, 'files')}/nowhere.csv"
    return files.read_csv_or(spark, missing, RAW_ORDERS, W(spark, sf).raw_orders().select(*RAW_COLUMNS))


@register("stage_type_map", f"select {DELTA_SQL} from delta_orders")
def stage_type_map(spark, sf):
    """All-text rows typed by the 26-column map of a stage load."""
    text = W(spark, sf).delta_orders().select(*[F.col(c).cast("string").alias(c) for c in DELTA_ORDERS.names])
    return files.typed(text, DELTA_ORDERS)


@register("alias_expressions", """
select order_number as order_ref, cast(order_date as varchar) as placed_on, cast(ship_date - order_date as bigint) as days_to_ship
from x_o2""")
def alias_expressions(spark, sf):
    """Columns and expressions under new names."""
    return W(spark, sf).final().orders.select(
        F.col("order_number").alias("order_ref"), F.col("order_date").alias("placed_on"),
        F.date_diff("ship_date", "order_date").alias("days_to_ship"))


@register("cast_to_text", """
select cast(order_detail_id as varchar) as id_text, cast(sales as varchar) as sales_text,
       cast(quantity as varchar) as quantity_text, cast(discount as varchar) as discount_text
from x_d2""")
def cast_to_text(spark, sf):
    """numbers and decimals as text."""
    d = W(spark, sf).final().order_details
    return d.select(*[F.col(c).cast("string").alias(f"{n}_text") for c, n in (
        ("order_detail_id", "id"), ("sales", "sales"), ("quantity", "quantity"), ("discount", "discount"))])


@register("fix_quantity_frame", """
select row_key, cast(case when quantity = 0 then 1 else quantity end as bigint) as quantity_of_zero,
       cast(case when quantity <= 0 then 1 else quantity end as bigint) as quantity_of_negative
from delta_orders""")
def fix_quantity_frame(spark, sf):
    """The two quantity repairs as functions of a frame."""
    return (W(spark, sf).delta_orders()
            .transform(lambda df: df.withColumn("quantity_of_zero", fc.repair_quantity("quantity")))
            .transform(lambda df: df.withColumn("quantity_of_negative", fc.repair_quantity_strict("quantity")))
            .select("row_key", "quantity_of_zero", "quantity_of_negative"))


@register("procedural_block", """
select cast((select batch_id from x_next_batch) as bigint) as next_batch,
       cast((select count(*) from x_new_orders) as bigint) as new_orders,
       cast((select count(*) from delta_orders) - (select count(*) from x_new_orders) as bigint) as skipped""")
def procedural_block(spark, sf):
    """An anonymous block with variables: the next batch and what it would insert."""
    w = W(spark, sf)
    own = f"b{w.root.rstrip('/').rsplit('/', 1)[1].replace('-', '_')}_"
    c = w.cleaned()
    for name, df in (("orders", c.orders), ("delta", w.delta_orders()), ("customers", w.secondary().customers)):
        df.createOrReplaceTempView(own + name)
    return spark.sql(f"""
begin
  declare next_batch int;
  declare staged, inserted bigint default 0;
  set next_batch = (select coalesce(max(batch_id), 1) + 1 from {own}orders);
  set staged = (select count(*) from {own}delta);
  set inserted = (select count(distinct d.order_id) from {own}delta d
                  join {own}customers c on c.customer_number = d.customer_id
                  left anti join {own}orders o on o.order_number = d.order_id);
  select next_batch, inserted as new_orders, staged - inserted as skipped;
end""")


@register("measure_of_measures", f"""
select category, cast(extract(year from period) as bigint) as year, cast(total as double) as total_sales, cast(before as double) as sales_sply,
       {syoy('total', 'before')} as sales_yoy
from (select category, period, max(now) as total, max(before) as before
      from (select category, period, sum(total_sales) as now, null as before from x_group_year group by all
            union all
            select category, cast(period + interval 12 month as date), null, sum(total_sales) from x_group_year group by all) u
      where period <= (select max(date) from x_calendar) group by all) t""")
def measure_of_measures(spark, sf):
    """Growth is a measure of two measures, sales and last year's sales, per category and year."""
    grown = ti.year_over_year(_fact(spark, sf), ["category"], _calendar(spark, sf), "year")
    return grown.select("category", F.year("period").alias("year"), "total_sales", "sales_sply", "sales_yoy")


@register("audit_recent_loads", """
select load_id, load_type, true as recent, true as in_order, true as today_or_before from x_audit_log""")
def audit_recent_loads(spark, sf):
    """Loads whose start lies within an interval before now, with times in order."""
    times = W(spark, sf).audit_times()
    return times.select(
        "load_id", "load_type", audit.started_within("3650 days").alias("recent"),
        (F.col("end_time") >= F.col("start_time")).alias("in_order"),
        (F.to_date("start_time") <= F.current_date()).alias("today_or_before"))


assert set(SQL_OF) == set(TABLES)
