"""Registered queries over the warehouse load steps (stage → core)."""

from __future__ import annotations

from ledgerloom.operators import audit, mart
from ledgerloom.operators import warehouse as wh
from ledgerloom.plans.registry import register
from ledgerloom.plans.warehouse_run import CORRECTION, warehouse as W

CUST = "cast(customer_id as bigint) as customer_id, customer_number, customer_name, segment"
ADDR = ("cast(address_id as bigint) as address_id, cast(customer_id as bigint) as customer_id, "
        "country, city, state, cast(postal_code as bigint) as postal_code, region, "
        "cast(valid_from as varchar) as valid_from, cast(valid_to as varchar) as valid_to, is_current")
PROD = "cast(product_id as bigint) as product_id, product_number, product_name, category, sub_category"
ORD = ("cast(order_id as bigint) as order_id, cast(customer_id as bigint) as customer_id, order_number, "
       "cast(order_date as varchar) as order_date, cast(ship_date as varchar) as ship_date, ship_mode, "
       "cast(batch_id as bigint) as batch_id")
DET = ("cast(order_detail_id as bigint) as order_detail_id, cast(order_id as bigint) as order_id, "
       "cast(product_id as bigint) as product_id, cast(sales as double) as sales, "
       "cast(quantity as bigint) as quantity, cast(discount as double) as discount, "
       "cast(profit as double) as profit")
FACT = ("cast(order_detail_id as bigint) as order_detail_id, cast(order_id as bigint) as order_id, "
        "order_number, cast(order_date as varchar) as order_date, cast(ship_date as varchar) as ship_date, "
        "ship_mode, cast(customer_id as bigint) as customer_id, cast(product_id as bigint) as product_id, "
        "sales_country, sales_region, sales_state, sales_city, cast(sales as double) as sales, "
        "cast(quantity as bigint) as quantity, cast(discount as double) as discount, "
        "cast(profit as double) as profit")


# ----------------------------------------------------------- initial load
@register("initial_customers", f"select {CUST} from x_c1")
def initial_customers(spark, sf):
    """M1: distinct stage customers, first-wins per customer number, dense ids."""
    return wh.initial_customers(W(spark, sf).raw_orders())


@register("initial_addresses", f"select {ADDR} from x_a1")
def initial_addresses(spark, sf):
    """M2: every distinct address, current, starting at the customer's first order."""
    w = W(spark, sf)
    return wh.initial_addresses(w.raw_orders(), w.initial().customers)


@register("initial_products", f"select {PROD} from x_p1")
def initial_products(spark, sf):
    """M3: distinct stage products, first-wins per product number, dense ids."""
    return wh.initial_products(W(spark, sf).raw_orders())


@register("initial_orders", f"select {ORD} from x_o1")
def initial_orders(spark, sf):
    """M4: order headers, batch 1, first-wins on conflicting ship dates."""
    w = W(spark, sf)
    return wh.initial_orders(w.raw_orders(), w.initial().customers)


@register("load_order_details", f"select {DET} from x_d1")
def load_order_details(spark, sf):
    """Stage ⋈ orders ⋈ products, appended as detail rows."""
    w = W(spark, sf)
    s = w.initial()
    return wh.initial_order_details(w.raw_orders(), s.orders, s.products)


@register("audit_initial", "select * from x_audit_initial")
def audit_initial(spark, sf):
    """Audit row of the initial load (processed = detail rows), as the load itself kept it."""
    return W(spark, sf).audit_log().where("load_type = 'INITIAL'")


# --------------------------------------------------------------- clean-up
@register("addresses_to_close", "select cast(address_id as bigint) as address_id from x_cleanup_close")
def addresses_to_close(spark, sf):
    """Current addresses that are not the customer's newest."""
    return wh.addresses_to_close(W(spark, sf).initial().addresses)


@register("cleanup_addresses", f"select {ADDR} from x_a2")
def cleanup_addresses(spark, sf):
    """One current address per customer after the clean-up."""
    return wh.cleanup_addresses(W(spark, sf).initial().addresses)


# -------------------------------------------------------- incremental load
@register("next_batch_id", "select cast(batch_id as bigint) as batch_id from x_next_batch")
def next_batch_id(spark, sf):
    """COALESCE(MAX(batch_id), 1) + 1."""
    return wh.next_batch_id(W(spark, sf).cleaned().orders)


@register("scd1_changed_rows", """
select cast(customer_id as bigint) as customer_id, customer_number, customer_name, segment, new_name, new_segment
from x_scd1""")
def scd1_changed_rows(spark, sf):
    """Customers whose name or segment differs (3-valued !=), with the winning value."""
    w = W(spark, sf)
    return wh.scd1_changes(w.cleaned().customers, w.delta_orders())


@register("scd1_customers", f"select {CUST} from x_c2")
def scd1_customers(spark, sf):
    """SCD type 1 overwrite, then insert-if-absent of new customers."""
    w = W(spark, sf)
    return wh.scd1_customers(w.cleaned().customers, w.delta_orders())[0]


@register("scd2_changed_rows", """
select cast(address_id as bigint) as address_id, cast(old_from as varchar) as old_from,
       cast(new_from as varchar) as new_from
from x_close""")
def scd2_changed_rows(spark, sf):
    """P10: current versions contradicted by a new-version row (5 attributes, null-safe)."""
    w = W(spark, sf)
    return wh.scd2_close_candidates(w.cleaned().addresses, w.secondary().customers,
                                    w.delta_orders())


@register("scd2_close_versions", f"select {ADDR} from x_a3")
def scd2_close_versions(spark, sf):
    """Close contradicted versions (day-before rule, same-day edge case)."""
    w = W(spark, sf)
    return wh.scd2_close_versions(w.cleaned().addresses, w.secondary().customers,
                                  w.delta_orders())[0]


@register("scd2_new_versions", f"select {ADDR} from x_new_versions")
def scd2_new_versions(spark, sf):
    """New current versions (4-attribute null-safe NOT EXISTS)."""
    w = W(spark, sf)
    closed, _ = wh.scd2_close_versions(w.cleaned().addresses, w.secondary().customers,
                                       w.delta_orders())
    return wh.scd2_new_versions(closed, w.secondary().customers, w.delta_orders())


@register("scd2_addresses", f"select {ADDR} from x_a4")
def scd2_addresses(spark, sf):
    """Full SCD type 2 step (close ∪ insert)."""
    w = W(spark, sf)
    return wh.scd2_addresses(w.cleaned().addresses, w.secondary().customers, w.delta_orders())[0]


@register("secondary_products", f"select {PROD} from x_new_products")
def secondary_products(spark, sf):
    """Insert-if-absent products of the batch."""
    w = W(spark, sf)
    return wh.secondary_products(w.cleaned().products, w.delta_orders())


@register("secondary_orders", f"select {ORD} from x_new_orders")
def secondary_orders(spark, sf):
    """Batch headers with ship-date repair and the next batch id."""
    w = W(spark, sf)
    return wh.secondary_orders(w.cleaned().orders, w.secondary().customers, w.delta_orders())


@register("secondary_order_details", f"select {DET} from x_new_details")
def secondary_order_details(spark, sf):
    """Batch lines for (order, product) pairs not loaded before."""
    w = W(spark, sf)
    s = w.secondary()
    return wh.secondary_order_details(w.cleaned().order_details, s.orders, s.products,
                                      w.delta_orders())


@register("audit_secondary", "select * from x_audit_secondary")
def audit_secondary(spark, sf):
    """Audit row of the incremental load, with the counts its writes took."""
    return W(spark, sf).audit_log().where("load_type = 'SECONDARY'")


# -------------------------------------------------------------- correction
@register("thin_by_hash", "select cast(order_detail_id as bigint) as order_detail_id from x_corr_doomed")
def thin_by_hash(spark, sf):
    """P20: lines of prefixed in-period orders outside the kept md5 bucket."""
    s = W(spark, sf).secondary()
    return wh.correct_period(s.orders, s.order_details, CORRECTION)[2]


@register("orphan_orders", "select cast(order_id as bigint) as order_id from x_corr_orphans")
def orphan_orders(spark, sf):
    """In-period orders left without lines (NOT IN as a left anti join)."""
    s = W(spark, sf).secondary()
    return wh.correct_period(s.orders, s.order_details, CORRECTION)[3]


@register("correct_period", f"select {ORD} from x_o3")
def correct_period(spark, sf):
    """Orders remaining after thinning and orphan removal."""
    s = W(spark, sf).secondary()
    return wh.correct_period(s.orders, s.order_details, CORRECTION)[0]


@register("audit_correction", """
select cast(3 as bigint) as load_id, 'DATA_CORRECTION' as load_type, 'period_cleanup' as source_table,
       cast((select count(*) from x_corr_doomed) + (select count(*) from x_corr_orphans) as bigint) as rows_processed,
       'COMPLETED' as status, cast(0 as bigint) as rows_inserted, cast(0 as bigint) as rows_updated,
       cast(0 as bigint) as rows_skipped""")
def audit_correction(spark, sf):
    """Correction audit with the real number of deleted rows."""
    s = W(spark, sf).secondary()
    _, _, doomed, orphans = wh.correct_period(s.orders, s.order_details, CORRECTION)
    return audit.audit_correction(doomed, orphans)


# ------------------------------------------------------------------- mart
@register("dim_products", f"select {PROD} from x_dim_products")
def dim_products(spark, sf):
    """Product dimension."""
    return mart.dim_products(W(spark, sf).final().products)


@register("dim_customers", """
select cast(customer_id as bigint) as customer_id, customer_number, customer_name, segment, country, city,
       state, region, cast(postal_code as bigint) as postal_code
from x_dim_customers""")
def dim_customers(spark, sf):
    """Customer with its newest current address (DISTINCT ON)."""
    s = W(spark, sf).final()
    return mart.dim_customers(s.customers, s.addresses)


@register("fact_sales", f"select {FACT} from x_fact")
def fact_sales(spark, sf):
    """Lines LEFT JOIN the address version valid on the order date."""
    s = W(spark, sf).final()
    return mart.fact_sales(s.order_details, s.orders, s.addresses)


@register("fact_sales_unique", f"select {FACT} from x_fact_unique")
def fact_sales_unique(spark, sf):
    """Point-in-time fact with exactly one row per line."""
    s = W(spark, sf).final()
    return mart.fact_sales_unique(s.order_details, s.orders, s.addresses)


@register("current_addresses", f"select {ADDR} from x_a4 where is_current")
def current_addresses(spark, sf):
    """Boolean filter on the version flag."""
    return mart.current_addresses(W(spark, sf).final().addresses)
