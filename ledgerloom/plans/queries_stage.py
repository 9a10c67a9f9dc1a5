"""Registered queries over the stage layer: cleaning, profiling, scalar
functions, stage aggregates, file sources/sinks and change detection."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions import columns as fc
from ledgerloom.operators import audit, cleaning, delta, mart
from ledgerloom.operators import warehouse as wh
from ledgerloom.operators.dedupe import first_per_key, insert_ignore
from ledgerloom.operators.keys import assign_dense_keys
from ledgerloom.plans import fixtures
from ledgerloom.plans.registry import register
from ledgerloom.plans.warehouse_run import warehouse as W
from ledgerloom.schemas import DELTA_COLUMNS, DELTA_ORDERS, RAW_COLUMNS, RAW_ORDERS
from ledgerloom.session import scratch_folder
from ledgerloom.sources import files

# Fixed query parameters.
TOP_REPEAT_CUSTOMERS = 20
HEAD_ROWS = 5
SAMPLE_ROWS = 50
DOMAIN_COLUMNS = ["segment", "region", "ship_mode", "category"]
KEY_COLUMNS = ["row_key", "order_id", "customer_id"]

RAW_SQL = ", ".join(
    f"cast({c} as double) as {c}" if c in ("sales", "discount", "profit") else
    f"cast({c} as bigint) as {c}" if c in ("postal_code", "quantity") else c
    for c in RAW_COLUMNS)
DELTA_SQL = RAW_SQL + ", valid_from, valid_to, previous_region, is_new_version, scd2_attribute_changed"


def _raw(spark, sf):
    return W(spark, sf).raw_orders()


def _delta(spark, sf):
    return W(spark, sf).delta_orders()


# ------------------------------------------------------------- aggregates
@register("count_details", "select cast(count(*) as bigint) as n from x_d2")
def count_details(spark, sf):
    """A1: COUNT(*) of the loaded lines."""
    return W(spark, sf).final().order_details.agg(F.count(F.lit(1)).alias("n"))


@register("orders_per_batch", """
select cast(batch_id as bigint) as batch_id, cast(count(*) as bigint) as count_orders from x_o2 group by batch_id""")
def orders_per_batch(spark, sf):
    """A2: orders per load batch."""
    return W(spark, sf).final().orders.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("count_orders"))


@register("having_count", """
select cast(customer_id as bigint) as customer_id, cast(count(*) as bigint) as n_addresses
from x_a4 group by customer_id having count(*) > 1""")
def having_count(spark, sf):
    """A3: customers with more than one address row."""
    return (W(spark, sf).final().addresses.groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("n_addresses")).filter(F.col("n_addresses") > 1))


@register("active_address_check", """
select (select cast(count(*) as bigint) from x_c1) as total_customers,
       (select cast(count(*) as bigint) from x_a2 where is_current) as active_addresses""")
def active_address_check(spark, sf):
    """Clean-up verification, two scalar aggregates side by side."""
    s = W(spark, sf).cleaned()
    return (s.customers.agg(F.count(F.lit(1)).alias("total_customers"))
            .crossJoin(s.addresses.agg(F.count_if(F.col("is_current")).alias("active_addresses"))))


@register("max_row_key", "select max(row_key) as max_row_key from raw_orders")
def max_row_key(spark, sf):
    """Max of a column."""
    return _raw(spark, sf).agg(F.max("row_key").alias("max_row_key"))


@register("distinct_customers", "select distinct customer_id, customer_name, segment from raw_orders")
def distinct_customers(spark, sf):
    """SELECT DISTINCT over several columns."""
    return _raw(spark, sf).select("customer_id", "customer_name", "segment").distinct()


@register("distinct_domain_values", "select distinct column_name, value from ("
          + " union all ".join(f"select '{c}' as column_name, cast({c} as varchar) as value from raw_orders"
                               for c in DOMAIN_COLUMNS) + ") t where value is not null")
def distinct_domain_values(spark, sf):
    """Distinct non-null values of the domain columns."""
    return cleaning.distinct_values(_raw(spark, sf), DOMAIN_COLUMNS)


@register("dedupe_customers", """
select customer_id, customer_name, segment, row_key from (
  select customer_id, customer_name, segment, row_key,
         row_number() over (partition by customer_id order by row_key, customer_name nulls last, segment nulls last) as rn
  from raw_orders) t where rn = 1""")
def dedupe_customers(spark, sf):
    """drop_duplicates(customer) keeping the first line in row order."""
    return first_per_key(_raw(spark, sf).select("customer_id", "customer_name", "segment", "row_key"),
                         ["customer_id"], fc.asc_last("row_key", "customer_name", "segment"))


@register("dedupe_products", """
select product_id, product_name, category, sub_category, row_key from (
  select product_id, product_name, category, sub_category, row_key,
         row_number() over (partition by product_id order by row_key, product_name nulls last, category nulls last, sub_category nulls last) as rn
  from raw_orders) t where rn = 1""")
def dedupe_products(spark, sf):
    """drop_duplicates(product) keeping the first line in row order."""
    return first_per_key(
        _raw(spark, sf).select("product_id", "product_name", "category", "sub_category", "row_key"),
        ["product_id"], fc.asc_last("row_key", "product_name", "category", "sub_category"))


@register("orders_per_customer", """
select customer_id, cast(count(*) as bigint) as n_lines from raw_orders group by customer_id""")
def orders_per_customer(spark, sf):
    """A10: value_counts of the customer column."""
    return _raw(spark, sf).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_lines"))


@register("unique_customers", " union all ".join(
    f"select '{c}' as column_name, cast(count(distinct {c}) as bigint) as unique_values from delta_orders"
    for c in KEY_COLUMNS))
def unique_customers(spark, sf):
    """Nunique of the key columns of the batch."""
    return cleaning.unique_counts(_delta(spark, sf), KEY_COLUMNS)


@register("duplicate_key_count", " union all ".join(
    f"select '{c}' as column_name, cast(count(*) - count(distinct {c}) - max(case when {c} is null then 1 else 0 end) as bigint) as duplicates from delta_orders"
    for c in KEY_COLUMNS))
def duplicate_key_count(spark, sf):
    """duplicated().sum() per key column."""
    return cleaning.duplicate_counts(_delta(spark, sf), KEY_COLUMNS)


@register("profile_columns", " union all ".join(
    f"select '{c}' as column_name, cast(count({c}) as bigint) as non_null, cast(count(*) as bigint) as row_count from delta_orders"
    for c in DELTA_COLUMNS))
def profile_columns(spark, sf):
    """Non-null count per column of the batch."""
    return cleaning.profile_columns(_delta(spark, sf))


@register("zero_quantity_count", """
select cast(count(*) filter (where quantity = 0) as bigint) as zero_quantity from delta_orders""")
def zero_quantity_count(spark, sf):
    """Conditional count."""
    return _delta(spark, sf).agg(F.count_if(F.col("quantity") == 0).alias("zero_quantity"))


@register("repeat_customers_top_n", f"""
select customer_id, cast(count(*) as bigint) as n_lines from raw_orders group by customer_id
having count(*) > 1 order by n_lines desc, customer_id limit {TOP_REPEAT_CUSTOMERS}""")
def repeat_customers_top_n(spark, sf):
    """Customers with history, the first N by line count."""
    return (_raw(spark, sf).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_lines"))
            .filter(F.col("n_lines") > 1)
            .orderBy(F.col("n_lines").desc(), "customer_id").limit(TOP_REPEAT_CUSTOMERS))


@register("head_rows", f"select {RAW_SQL} from raw_orders order by row_key, sales, ship_date limit {HEAD_ROWS}")
def head_rows(spark, sf):
    """head() in row order."""
    return (_raw(spark, sf).select(*RAW_COLUMNS)
            .orderBy("row_key", "sales", "ship_date").limit(HEAD_ROWS))


@register("sample_n_rows", f"select {RAW_SQL} from raw_orders order by md5(row_key), row_key, sales, ship_date limit {SAMPLE_ROWS}")
def sample_n_rows(spark, sf):
    """T5: seeded sample of exactly n rows (md5 order)."""
    return cleaning.deterministic_sample(_raw(spark, sf).select(*RAW_COLUMNS), "row_key", SAMPLE_ROWS,
                                         ["sales", "ship_date"])


@register("last_line_per_customer", """
select customer_id, row_key, order_date, region from (
  select customer_id, row_key, order_date, region,
         row_number() over (partition by customer_id order by order_date desc, row_key desc, sales desc, ship_date desc, order_id desc, product_id desc) as rn
  from raw_orders) t where rn = 1""")
def last_line_per_customer(spark, sf):
    """Each customer's last line (iloc[-1] per group, by date then row)."""
    return delta.last_line_per_customer(_raw(spark, sf)).select(
        "customer_id", "row_key", "order_date", "region")


@register("assign_surrogate_keys", """
select cast(row_number() over (order by row_key, sales, ship_date) as bigint) as row_id, row_key,
       cast(sales as double) as sales, ship_date
from raw_orders""")
def assign_surrogate_keys(spark, sf):
    """Dense sequential ids over all lines (distributed numbering)."""
    lines = _raw(spark, sf).select("row_key", "sales", "ship_date")
    return assign_dense_keys(lines, "row_id", fc.asc_last("row_key", "sales", "ship_date"))


# -------------------------------------------------------- scalar functions
@register("parse_dates", """
select row_key, cast(try_cast(order_date as date) as varchar) as order_day,
       strftime(try_cast(order_date as date), '%-m/%-d/%Y') as order_date_us,
       cast(cast(try_strptime(strftime(try_cast(order_date as date), '%-m/%-d/%Y'), '%m/%d/%Y') as date) as varchar) as order_day_from_us
from delta_orders""")
def parse_dates(spark, sf):
    """F1 / F2: ISO text → date, date → month/day/year text, and back (strict)."""
    d = _delta(spark, sf).select("row_key", fc.parse_date("order_date").alias("order_day"))
    d = d.withColumn("order_date_us", F.date_format("order_day", "M/d/yyyy"))
    return d.withColumn("order_day_from_us", fc.parse_date_us("order_date_us"))


@register("parse_dates_lenient", """
select row_key, mixed, cast(coalesce(try_cast(nullif(trim(mixed), '') as date), cast(try_strptime(nullif(trim(mixed), ''), '%m/%d/%Y') as date)) as varchar) as parsed
from (select row_key,
             case (('0x' || substr(md5(row_key), 1, 4))::INT % 100) % 4
                  when 0 then order_date
                  when 1 then strftime(try_cast(order_date as date), '%-m/%-d/%Y')
                  when 2 then order_date || ' 10:11:12'
                  else 'n/a' end as mixed
      from delta_orders) t""")
def parse_dates_lenient(spark, sf):
    """mixed-format text, first parse that works, garbage → NULL."""
    d = _delta(spark, sf)
    b = fc.md5_bucket("row_key") % 4
    mixed = (F.when(b == 0, F.col("order_date"))
             .when(b == 1, F.date_format(fc.parse_date("order_date"), "M/d/yyyy"))
             .when(b == 2, F.concat("order_date", F.lit(" 10:11:12")))
             .otherwise(F.lit("n/a")))
    return (d.select("row_key", mixed.alias("mixed"))
            .withColumn("parsed", fc.parse_date_lenient("mixed")))


@register("format_dates", """
select row_key, strftime(eff_from, '%Y-%m-%d') as valid_from_text from x_delta""")
def format_dates(spark, sf):
    """date → ISO text."""
    return _delta(spark, sf).select(
        "row_key", fc.format_date(fc.effective_from("valid_from", "order_date")).alias("valid_from_text"))


@register("coerce_numeric", """
select row_key, postal_text, cast(try_cast(postal_text as integer) as bigint) as postal_number
from (select row_key, case when postal_code is null then 'n/a' else cast(postal_code as varchar) end as postal_text
      from raw_orders) t""")
def coerce_numeric(spark, sf):
    """text → number, unparseable → NULL."""
    r = _raw(spark, sf).select(
        "row_key", F.when(F.col("postal_code").isNull(), F.lit("n/a"))
        .otherwise(F.col("postal_code").cast("string")).alias("postal_text"))
    return r.withColumn("postal_number", F.col("postal_text").try_cast("int"))


@register("shift_dates", """
select row_key, cast(try_cast(order_date as date) + cast(k_cust % 200 as int) as varchar) as shifted
from raw_orders""")
def shift_dates(spark, sf):
    """F8: date + per-row number of days."""
    r = _raw(spark, sf)
    return r.select("row_key", F.date_add(fc.parse_date("order_date"),
                                          (F.col("k_cust") % 200).cast("int")).alias("shifted"))


@register("repair_ship_date", """
select row_key, order_date, ship_date,
       cast(greatest(try_cast(ship_date as date), try_cast(order_date as date)) as varchar) as repaired_ship_date
from delta_orders""")
def repair_ship_date(spark, sf):
    """GREATEST(ship, order)."""
    d = _delta(spark, sf)
    return d.select("row_key", "order_date", "ship_date",
                    fc.repair_ship_date(fc.parse_date("ship_date"), fc.parse_date("order_date"))
                    .alias("repaired_ship_date"))


@register("repair_quantity", """
select row_key, cast(quantity as bigint) as quantity,
       cast(case when quantity = 0 then 1 else quantity end as bigint) as repaired_quantity from delta_orders""")
def repair_quantity(spark, sf):
    """quantity 0 → 1."""
    return _delta(spark, sf).select("row_key", "quantity",
                                    fc.repair_quantity("quantity").alias("repaired_quantity"))


@register("repair_quantity_strict", """
select row_key, cast(quantity - 1 as bigint) as quantity,
       cast(case when quantity - 1 <= 0 then 1 else quantity - 1 end as bigint) as repaired_quantity from delta_orders""")
def repair_quantity_strict(spark, sf):
    """Any quantity ≤ 0 → 1 (over quantities lowered by one, so
    negative values occur)."""
    d = _delta(spark, sf).select("row_key", (F.col("quantity") - 1).alias("quantity"))
    return d.withColumn("repaired_quantity", fc.repair_quantity_strict("quantity"))


@register("tag_updated_names", """
select row_key, concat(customer_name, ' (Updated)') as customer_name from raw_orders""")
def tag_updated_names(spark, sf):
    """the rename suffix of the SCD1 scenario, over every line."""
    return _raw(spark, sf).select(
        "row_key", F.concat("customer_name", F.lit(" (Updated)")).alias("customer_name"))


@register("rescale_sales", """
select row_key, cast(cast(sales * 1.1 as decimal(10,2)) as double) as sales from raw_orders""")
def rescale_sales(spark, sf):
    """F16: scale by 1.1 and round to cents (half up)."""
    return _raw(spark, sf).select(
        "row_key", (F.col("sales") * F.lit(Decimal("1.1"))).cast("decimal(10,2)").alias("sales"))


@register("line_amount", """
select row_key, cast(round(sales * quantity * (1 - discount), 2) as double) as line_amount from raw_orders""")
def line_amount(spark, sf):
    """price × quantity × (1 − discount)."""
    return _raw(spark, sf).select(
        "row_key", fc.line_amount("sales", "quantity", "discount").alias("line_amount"))


# --------------------------------------------------- projections & filters
@register("rename_columns", f"select {RAW_SQL} from raw_orders")
def rename_columns(spark, sf):
    """Source header names → snake-case stage names."""
    src = _raw(spark, sf).select(*[F.col(c).alias(h) for c, h in files.TO_SOURCE_HEADER.items()])
    return cleaning.rename_columns(src, files.FROM_SOURCE_HEADER)


@register("batch_tagging", """
select row_key, order_id, cast((select batch_id from x_next_batch) as bigint) as batch_id, true as is_current
from delta_orders""")
def batch_tagging(spark, sf):
    """Constant columns (batch id, current flag) on every batch row."""
    w = W(spark, sf)
    return (w.delta_orders().select("row_key", "order_id")
            .crossJoin(F.broadcast(wh.next_batch_id(w.cleaned().orders)))
            .withColumn("is_current", F.lit(True)))


@register("schema_align", f"""
select {RAW_SQL}, order_date as valid_from, '' as valid_to, '' as previous_region, false as is_new_version,
       '' as scd2_attribute_changed
from raw_orders""")
def schema_align(spark, sf):
    """P5: add the versioning columns with defaults and order the 26 columns."""
    r = _raw(spark, sf).select(*RAW_COLUMNS)
    defaults = {"valid_from": F.col("order_date"), "valid_to": F.lit(""),
                "previous_region": F.lit(""), "is_new_version": F.lit(False),
                "scd2_attribute_changed": F.lit("")}
    return cleaning.align_to(r, DELTA_COLUMNS, defaults)


@register("union_delta_parts", f"select {DELTA_SQL} from delta_orders")
def union_delta_parts(spark, sf):
    """The four scenario parts concatenated by name (bag union)."""
    w = W(spark, sf)
    return cleaning.union_aligned(fixtures.delta_parts(spark, sf, w.raw_orders(), w.new_lines()), DELTA_COLUMNS, {})


@register("fill_postal_code", """
select row_key, cast(coalesce(postal_code, 0) as bigint) as postal_code from raw_orders""")
def fill_postal_code(spark, sf):
    """NULL → default."""
    return cleaning.fill_nulls(_raw(spark, sf).select("row_key", "postal_code"), {"postal_code": 0})


@register("scd2_effective_date", """
select row_key, cast(eff_from as varchar) as effective_from from x_delta""")
def scd2_effective_date(spark, sf):
    """valid_from if present and non-blank, else the order date."""
    return _delta(spark, sf).select(
        "row_key", fc.effective_from("valid_from", "order_date").alias("effective_from"))


# ------------------------------------------------------------------ joins
@register("key_lookup_customers", """
select ro.row_key, cast(c.customer_id as bigint) as customer_id from raw_orders ro join x_c1 c on ro.customer_id = c.customer_number""")
def key_lookup_customers(spark, sf):
    """Business key → surrogate key."""
    w = W(spark, sf)
    c = w.initial().customers.select("customer_id", F.col("customer_number").alias("_num"))
    return (w.raw_orders().select("row_key", F.col("customer_id").alias("_num"))
            .join(c, "_num").select("row_key", "customer_id"))


@register("upsert_insert_ignore", """
select customer_number, customer_name, segment from x_new_customers""")
def upsert_insert_ignore(spark, sf):
    """Insert-if-absent rows (first wins per key, existing keys skipped)."""
    w = W(spark, sf)
    incoming = w.delta_orders().select(F.col("customer_id").alias("customer_number"),
                                       "customer_name", "segment")
    return insert_ignore(w.cleaned().customers, incoming, "customer_number")


@register("anti_order_product", """
select cast(o.order_id as bigint) as order_id, cast(p.product_id as bigint) as product_id, cast(s.sales as double) as sales,
       cast(case when s.quantity = 0 then 1 else s.quantity end as bigint) as quantity,
       cast(s.discount as double) as discount, cast(s.profit as double) as profit
from delta_orders s join x_o2 o on s.order_id = o.order_number join x_p2 p on s.product_id = p.product_number
anti join x_d1_pairs d on d.order_id = o.order_id and d.product_id = p.product_id""")
def anti_order_product(spark, sf):
    """NOT EXISTS on (order, product) against the loaded lines."""
    w = W(spark, sf)
    s = w.secondary()
    return wh.new_detail_rows(w.cleaned().order_details, s.orders, s.products, w.delta_orders())


@register("semi_in_subquery", """
select cast(order_detail_id as bigint) as order_detail_id from x_d2 where order_id in (select order_id from x_corr_targets)""")
def semi_in_subquery(spark, sf):
    """IN (subquery) as a left semi join."""
    from ledgerloom.plans.warehouse_run import CORRECTION
    s = W(spark, sf).secondary()
    return (s.order_details.join(wh.correction_targets(s.orders, CORRECTION), "order_id", "left_semi")
            .select("order_detail_id"))


@register("filter_date_between", """
select cast(order_id as bigint) as order_id, order_number, cast(order_date as varchar) as order_date
from x_o2 where order_date between date '2000-01-01' and date '2000-12-31'""")
def filter_date_between(spark, sf):
    """Inclusive date range (pushed to the Parquet scan)."""
    import datetime as dt
    o = W(spark, sf).final().orders
    return (o.filter(F.col("order_date").between(F.lit(dt.date(2000, 1, 1)), F.lit(dt.date(2000, 12, 31))))
            .select("order_id", "order_number", "order_date"))


@register("filter_like_prefix", """
select cast(order_id as bigint) as order_id, order_number from x_o2 where order_number like 'ORD-1%'""")
def filter_like_prefix(spark, sf):
    """LIKE 'prefix%' (pushed as StringStartsWith)."""
    o = W(spark, sf).final().orders
    return o.filter(F.col("order_number").startswith("ORD-1")).select("order_id", "order_number")


@register("customers_updated_names", """
select cast(customer_id as bigint) as customer_id, customer_number, customer_name from x_c2
where customer_name like '%(Updated)%'""")
def customers_updated_names(spark, sf):
    """LIKE '%…%' — evidence of the SCD1 overwrite."""
    c = W(spark, sf).secondary().customers
    return (c.filter(F.col("customer_name").contains("(Updated)"))
            .select("customer_id", "customer_number", "customer_name"))


@register("customers_with_history", """
select c.customer_name, a.region, a.city, cast(a.valid_from as varchar) as valid_from,
       cast(a.valid_to as varchar) as valid_to, a.is_current
from x_a4 a join x_c2 c on a.customer_id = c.customer_id
where c.customer_id in (select customer_id from x_a4 group by customer_id having count(*) > 1)""")
def customers_with_history(spark, sf):
    """Address rows of customers with several versions (IN … HAVING)."""
    s = W(spark, sf).final()
    multi = s.addresses.groupBy("customer_id").count().filter(F.col("count") > 1).select("customer_id")
    return (s.addresses.join(multi, "customer_id", "left_semi")
            .join(s.customers.select("customer_id", "customer_name"), "customer_id")
            .select("customer_name", "region", "city", "valid_from", "valid_to", "is_current"))


@register("stage_customers_with_history", """
select customer_name, region, city from raw_orders
where customer_id in (select customer_id from raw_orders group by customer_id having count(*) > 1)""")
def stage_customers_with_history(spark, sf):
    """P15 (stage form): lines of customers with more than one *line* in the
    stage — the check counts order lines, not addresses."""
    r = _raw(spark, sf)
    multi = (r.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > 1).select("customer_id"))
    return r.join(multi, "customer_id", "left_semi").select("customer_name", "region", "city")


@register("customers_distinct_addresses", """
select customer_id, cast(count(*) as bigint) as distinct_addresses from (
  select distinct customer_id, country, city, state, postal_code, region from raw_orders) t
group by customer_id having count(*) > 1""")
def customers_distinct_addresses(spark, sf):
    """Q17: customers whose stage lines carry more than one distinct address
    (the count the line-based check stands in for)."""
    r = _raw(spark, sf).select("customer_id", "country", "city", "state", "postal_code", "region")
    return (r.distinct().groupBy("customer_id").agg(F.count(F.lit(1)).alias("distinct_addresses"))
            .filter(F.col("distinct_addresses") > 1))


@register("address_history", """
select c.customer_name, cast(c.customer_id as bigint) as customer_id, a.region, cast(a.valid_from as varchar) as valid_from,
       cast(a.valid_to as varchar) as valid_to, a.is_current
from x_a4 a join x_c2 c on a.customer_id = c.customer_id
where c.customer_id in (select customer_id from x_a4 group by customer_id having count(*) > 1)""")
def address_history(spark, sf):
    """Version history per customer, ordered by name and start."""
    s = W(spark, sf).final()
    multi = s.addresses.groupBy("customer_id").count().filter(F.col("count") > 1).select("customer_id")
    return (s.addresses.join(multi, "customer_id", "left_semi")
            .join(s.customers.select("customer_id", "customer_name"), "customer_id")
            .select("customer_name", "customer_id", "region", "valid_from", "valid_to", "is_current")
            .orderBy("customer_name", "valid_from"))


@register("star_sales_wide", """
select cast(f.order_detail_id as bigint) as order_detail_id, cast(f.order_date as varchar) as order_date,
       cast(c.year as bigint) as year, cast(c.month as bigint) as month, p.category, p.sub_category, p.product_name,
       d.segment, d.customer_name, f.sales_region, cast(f.sales as double) as sales, cast(f.profit as double) as profit
from x_fact f join x_dim_products p on f.product_id = p.product_id
left join x_dim_customers d on f.customer_id = d.customer_id
join x_calendar c on c.date = f.order_date""")
def star_sales_wide(spark, sf):
    """Fact joined to its product, customer and calendar dimensions."""
    w = W(spark, sf)
    f = w.fact_sales()
    cal = mart.calendar(f).select(F.col("date").alias("order_date"), "year", "month")
    return (f.join(w.dim_products().select("product_id", "category", "sub_category", "product_name"),
                   "product_id")
            .join(w.dim_customers().select("customer_id", "segment", "customer_name"), "customer_id", "left")
            .join(cal, "order_date")
            .select("order_detail_id", "order_date", "year", "month", "category", "sub_category",
                    "product_name", "segment", "customer_name", "sales_region", "sales", "profit"))


# ------------------------------------------------------- change detection
@register("delta_duplicates", "select i.row_key, i.order_id, i.customer_id from delta_orders i where exists (select 1 from raw_orders o where "
          + " and ".join(f"o.{c} is not distinct from i.{c}" for c in delta.BUSINESS_COLUMNS) + ")")
def delta_duplicates(spark, sf):
    """Incoming lines identical to a loaded line on all business columns."""
    return delta.delta_duplicates(_raw(spark, sf), _delta(spark, sf)).select(
        "row_key", "order_id", "customer_id")


@register("delta_scd1_rows", """
select i.row_key, i.customer_id,
       bool_or(i.customer_name is distinct from o.customer_name) as name_changed,
       bool_or(i.segment is distinct from o.segment) as segment_changed,
       bool_or(i.sales is distinct from o.sales) as sales_changed
from delta_orders i join raw_orders o on i.order_id = o.order_id and i.product_id = o.product_id
group by i.row_key, i.customer_id
having bool_or(i.customer_name is distinct from o.customer_name) or bool_or(i.segment is distinct from o.segment)
    or bool_or(i.sales is distinct from o.sales)""")
def delta_scd1_rows(spark, sf):
    """Re-sent lines with changed name, segment or amount."""
    return delta.delta_scd1_rows(_raw(spark, sf), _delta(spark, sf))


@register("delta_scd2_rows", """
select i.row_key, i.customer_id, p.region as previous_region, i.region, true as is_new_version,
       case when i.region is distinct from p.region then 'region'
            when i.state is distinct from p.state then 'state'
            when i.city is distinct from p.city then 'city'
            when i.postal_code is distinct from p.postal_code then 'postal_code'
            else 'country' end as scd2_attribute_changed
from delta_orders i join (
  select * from (select *, row_number() over (partition by customer_id order by order_date desc, row_key desc, sales desc, ship_date desc, order_id desc, product_id desc) as rn
                 from raw_orders) t where rn = 1) p on i.customer_id = p.customer_id
where i.region is distinct from p.region or i.state is distinct from p.state or i.city is distinct from p.city
   or i.postal_code is distinct from p.postal_code or i.country is distinct from p.country""")
def delta_scd2_rows(spark, sf):
    """Incoming address vs the customer's last known line → version columns."""
    return delta.delta_scd2_rows(_raw(spark, sf), _delta(spark, sf))


# ---------------------------------------------------- sources and sinks
def _files(spark, sf, name):
    """A folder of this call alone: an earlier result may still read its files."""
    return f"{scratch_folder(spark, 'files')}/{name}"


@register("src_csv_latin1", f"select {RAW_SQL} from raw_orders")
def src_csv_latin1(spark, sf):
    """Header CSV in Latin-1, explicit schema, renamed to stage names."""
    path = _files(spark, sf, "raw_orders_latin1")
    files.write_source_csv(_raw(spark, sf), path, files.LATIN1)
    return files.read_source_csv(spark, path, files.LATIN1).select(*RAW_COLUMNS)


@register("src_csv_utf8", f"select {RAW_SQL} from raw_orders")
def src_csv_utf8(spark, sf):
    """CSV with reader defaults (UTF-8, no header), positional schema."""
    path = _files(spark, sf, "raw_orders_utf8")
    files.write_csv(_raw(spark, sf).select(*RAW_COLUMNS), path, header=False)
    return files.read_csv(spark, path, RAW_ORDERS, header=False)


@register("sink_csv_roundtrip", f"select {DELTA_SQL} from delta_orders")
def sink_csv_roundtrip(spark, sf):
    """S3: CSV sink (UTF-8, header, no index) read back with the stage schema."""
    path = _files(spark, sf, "delta_orders_csv")
    files.write_csv(_delta(spark, sf), path, header=True)
    return files.read_csv(spark, path, DELTA_ORDERS, header=True)


@register("stage_replace", f"select {RAW_SQL} from raw_orders")
def stage_replace(spark, sf):
    """Typed stage load, replace."""
    path = _files(spark, sf, "stage_raw_orders")
    files.write_stage(_raw(spark, sf), path, RAW_ORDERS, mode="overwrite")
    return files.read_stage(spark, path, RAW_ORDERS)


@register("stage_append", f"select {RAW_SQL} from raw_orders union all select {RAW_SQL} from delta_orders")
def stage_append(spark, sf):
    """Typed stage load, append (replace with the first batch, append the next)."""
    path = _files(spark, sf, "stage_all_orders")
    files.write_stage(_raw(spark, sf), path, RAW_ORDERS, mode="overwrite")
    files.write_stage(_delta(spark, sf), path, RAW_ORDERS, mode="append")
    return files.read_stage(spark, path, RAW_ORDERS)


def _audit_log(spark, sf):
    return W(spark, sf).audit_log()


@register("audit_start", """
select cast(max(load_id) + 1 as bigint) as load_id, 'SECONDARY' as load_type,
       'stage.delta_orders' as source_table, cast(0 as bigint) as rows_processed, 'STARTED' as status,
       cast(0 as bigint) as rows_inserted, cast(0 as bigint) as rows_updated, cast(0 as bigint) as rows_skipped
from x_audit_log""")
def audit_start(spark, sf):
    """Open a load: next id after the audit log, status STARTED, zero counters."""
    log = _audit_log(spark, sf)
    nxt = log.agg((F.coalesce(F.max("load_id"), F.lit(0)) + 1).alias("load_id"))
    return nxt.select("load_id", F.lit("SECONDARY").alias("load_type"),
                      F.lit("stage.delta_orders").alias("source_table"),
                      F.lit(0).cast("long").alias("rows_processed"), F.lit("STARTED").alias("status"),
                      *[F.lit(0).cast("long").alias(c) for c in ("rows_inserted", "rows_updated", "rows_skipped")])


@register("evolve_audit_columns", """
select load_id, load_type, source_table, rows_processed, status, cast(0 as bigint) as rows_inserted,
       cast(0 as bigint) as rows_updated, cast(0 as bigint) as rows_skipped
from x_audit_log""")
def evolve_audit_columns(spark, sf):
    """Audit rows read without the counter columns, evolved by adding
    them with default 0. (The secondary row's counters then read 0, as in a
    table altered after the load.)"""
    old_shape = _audit_log(spark, sf).drop("rows_inserted", "rows_updated", "rows_skipped")
    return audit.evolve_audit_columns(old_shape)


@register("mart_snapshot", """
select cast(year(order_date) as bigint) as order_year, cast(count(*) as bigint) as fact_rows,
       cast(sum(sales) as double) as total_sales from x_fact group by 1""")
def mart_snapshot(spark, sf):
    """The mart materialised as Parquet partitioned by order year."""
    return W(spark, sf).fact_by_year().groupBy("order_year").agg(F.count(F.lit(1)).alias("fact_rows"),
                                          F.sum("sales").alias("total_sales"))
