"""Independent SQL statement of every registered query, for DuckDB.

Each warehouse step is a named CTE written straight from the load scripts'
semantics (with the deterministic tie-breaks documented in the survey). A
query's SQL is its final SELECT prefixed by every CTE it needs, found by name.
Output conventions match :func:`ledgerloom.plans.registry.surface`: dates as
ISO text, money as double, integers as bigint.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def compose(final_sql: str) -> str:
    """Prefix ``final_sql`` with the CTEs it (transitively) references, in
    dependency order."""
    order: list[str] = []

    def refs(sql: str) -> list[str]:
        return [n for n in CTES if re.search(rf"\b{n}\b", sql)]

    def visit(n: str, stack: tuple[str, ...] = ()) -> None:
        if n in order:
            return
        for d in refs(CTES[n]):
            if d != n and d not in stack:
                visit(d, stack + (n,))
        order.append(n)

    for n in refs(final_sql):
        visit(n)
    if not order:
        return final_sql.strip()
    # A statement that several others read is computed once.
    texts = [CTES[n] for n in order] + [final_sql]
    shared = {n for n in order if sum(len(re.findall(rf"\b{n}\b", t)) for t in texts) > 1}
    body = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in shared else ''}(\n{CTES[n]}\n)"
                      for n in order)
    return f"WITH {body}\n{final_sql.strip()}"


# --------------------------------------------------------------- fixtures
cte("fx_lines", """
select concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), cast(l_suppkey as string)) as row_key,
 concat('ORD-', cast(o_orderkey as string)) as order_id, cast(cast(o_orderdate as date) as string) as order_date, cast(cast(l_shipdate as date) as string) as ship_date,
 o_orderpriority as ship_mode, concat('CUST-', cast(c_custkey as string)) as customer_id, c_name as customer_name,
 case when c_custkey % 19 = 0 then null else c_mktsegment end as segment, 'USA' as country,
 concat('CITY_', cast(case when c_custkey % 5 = 0 then o_orderkey % 2 else c_custkey % 40 end as string)) as city, n_name as state,
 case when c_custkey % 17 = 0 then null else cast(10000 + c_custkey % 900 as int) end as postal_code, r_name as region,
 concat('PROD-', cast(p_partkey as string)) as product_id, p_type as category, p_brand as sub_category, p_name as product_name,
 cast(cast(l_extendedprice as decimal(10,2)) * (1 - cast(l_discount as decimal(5,2))) as decimal(10,2)) as sales,
 cast(l_quantity as int) as quantity, case when o_orderkey % 41 = 0 then null else cast(l_discount as decimal(5,2)) end as discount,
 cast(cast(l_extendedprice as decimal(10,2)) * (cast(0.30 as decimal(5,2)) - cast(l_discount as decimal(5,2))) - cast(l_quantity as int) * p_size * case when p_brand = 'Brand#11' then 40 else 4 end as decimal(10,2)) as profit,
 o_orderkey as k_order, c_custkey as k_cust, l_linenumber as k_line, r_regionkey as k_region, p_partkey as k_part
 from lineitem join orders on l_orderkey=o_orderkey join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey join part on l_partkey=p_partkey
""")

cte("raw_orders", """
select row_key,order_id,order_date,ship_date,ship_mode,customer_id,customer_name,segment,country,city,state,postal_code,region,product_id,category,sub_category,product_name,sales,quantity,discount,profit, k_order,k_cust,k_line,k_region
from fx_lines where order_date < '2000-01-01' and k_cust % 13 <> 0 and k_part % 97 <> 0
""")

cte("delta_orders", """
select row_key,order_id,order_date,ship_date,ship_mode,customer_id,customer_name,segment,country,city,state,postal_code,region,product_id,category,sub_category,product_name,sales,case when k_order % 29 = 0 then 0 else quantity end as quantity,discount,profit, order_date as valid_from, '' as valid_to, '' as previous_region, k_cust % 13 = 0 as is_new_version, '' as scd2_attribute_changed from fx_lines where order_date >= '2000-01-01' or k_cust % 13 = 0 or k_part % 97 = 0
union all select row_key,order_id,order_date,ship_date,ship_mode,customer_id,customer_name,segment,country,city,state,postal_code,region,product_id,category,sub_category,product_name,sales,quantity,discount,profit, order_date, '', '', false, '' from raw_orders where k_order % 50 = 0
union all select concat('S1-',row_key),order_id,order_date,ship_date,ship_mode,customer_id,concat(customer_name,' (Updated)'),segment,country,city,state,postal_code,region,product_id,category,sub_category,product_name,cast(sales*1.1 as decimal(10,2)),quantity,discount,profit, order_date, '', '', false, '' from raw_orders where k_cust % 11 = 0 and k_line = 1
union all select concat('S2-',row_key), concat('SCD2-',order_id,'-V2'), cast(nd as string), cast(nd + 3 as string), ship_mode,customer_id,customer_name,segment,country,city,state,postal_code, nr, product_id,category,sub_category,product_name,sales,quantity,discount,profit, cast(nd as string), '', region, true, 'region'
from (select t.*, r.r_name as nr, cast(case when k_cust % 21 = 0 then date '1995-01-01' else date '2000-01-01' + cast(k_cust % 200 as int) end as date) as nd
      from (select x.*, row_number() over (partition by customer_id order by order_date desc, row_key desc, sales desc, ship_date desc, order_id desc, product_id desc) as rn
            from raw_orders x where k_cust % 7 = 0) t
      join region r on r.r_regionkey = (t.k_region + 1) % 5 where rn = 1) z
""")

cte("x_delta", """
select *, coalesce(try_cast(nullif(trim(valid_from), '') as date), try_cast(nullif(trim(order_date), '') as date)) as eff_from
from delta_orders
""")

# ----------------------------------------------------------- initial load
cte("x_c1", """
select row_number() over (order by customer_number) as customer_id, customer_number, customer_name, segment
from (select customer_id as customer_number, customer_name, segment,
             row_number() over (partition by customer_id order by customer_name asc nulls last, segment asc nulls last) as rn
      from raw_orders) t
where rn = 1
""")

cte("x_a1", """
select row_number() over (order by customer_id, country nulls last, city nulls last, state nulls last, postal_code nulls last, region nulls last, valid_from nulls last) as address_id,
       customer_id, country, city, state, postal_code, region, valid_from, cast(null as date) as valid_to, true as is_current
from (select distinct c.customer_id, ro.country, ro.city, ro.state, ro.postal_code, ro.region,
             min(try_cast(ro.order_date as date)) over (partition by ro.customer_id) as valid_from
      from raw_orders ro join x_c1 c on ro.customer_id = c.customer_number) t
""")

cte("x_p1", """
select row_number() over (order by product_number) as product_id, product_number, product_name, category, sub_category
from (select product_id as product_number, product_name, category, sub_category,
             row_number() over (partition by product_id order by product_name nulls last, category nulls last, sub_category nulls last) as rn
      from raw_orders) t
where rn = 1
""")

cte("x_o1", """
select row_number() over (order by order_number) as order_id, customer_id, order_number, order_date, ship_date, ship_mode, 1 as batch_id
from (select c.customer_id, ro.order_id as order_number, try_cast(ro.order_date as date) as order_date,
             try_cast(ro.ship_date as date) as ship_date, ro.ship_mode,
             row_number() over (partition by ro.order_id order by c.customer_id nulls last, try_cast(ro.order_date as date) nulls last,
                                try_cast(ro.ship_date as date) nulls last, ro.ship_mode nulls last) as rn
      from raw_orders ro join x_c1 c on ro.customer_id = c.customer_number) t
where rn = 1
""")

cte("x_d1", """
select row_number() over (order by o.order_id, p.product_id, ro.sales nulls last, ro.quantity nulls last, ro.discount nulls last, ro.profit nulls last) as order_detail_id,
       o.order_id, p.product_id, ro.sales, ro.quantity, ro.discount, ro.profit
from raw_orders ro join x_o1 o on ro.order_id = o.order_number join x_p1 p on ro.product_id = p.product_number
""")

# --------------------------------------------------------------- clean-up
cte("x_cleanup_close", """
select address_id from (
  select address_id, row_number() over (partition by customer_id order by valid_from desc, address_id desc) as rn
  from x_a1 where is_current) t
where rn > 1
""")

cte("x_a2", """
select a.address_id, a.customer_id, a.country, a.city, a.state, a.postal_code, a.region, a.valid_from,
       case when k.address_id is not null then a.valid_from + 1 else a.valid_to end as valid_to,
       case when k.address_id is not null then false else a.is_current end as is_current
from x_a1 a left join x_cleanup_close k on a.address_id = k.address_id
""")

# -------------------------------------------------------- incremental load
cte("x_scd1", """
select customer_id, customer_number, customer_name, segment, new_name, new_segment from (
  select c.customer_id, c.customer_number, c.customer_name, c.segment, s.customer_name as new_name, s.segment as new_segment,
         row_number() over (partition by c.customer_id order by try_cast(s.order_date as date) desc nulls last, s.row_key desc nulls last,
                            s.customer_name desc nulls last, s.segment desc nulls last) as rn
  from x_c1 c join delta_orders s on c.customer_number = s.customer_id
  where c.customer_name <> s.customer_name or c.segment <> s.segment) t
where rn = 1
""")

cte("x_new_customers", """
select (select coalesce(max(customer_id), 0) from x_c1) + row_number() over (order by customer_number) as customer_id,
       customer_number, customer_name, segment
from (select customer_id as customer_number, customer_name, segment,
             row_number() over (partition by customer_id order by customer_name nulls last, segment nulls last) as rn
      from delta_orders d
      where not exists (select 1 from x_c1 c where c.customer_number = d.customer_id)) t
where rn = 1
""")

cte("x_c2", """
select c.customer_id, c.customer_number,
       case when u.customer_id is not null then u.new_name else c.customer_name end as customer_name,
       case when u.customer_id is not null then u.new_segment else c.segment end as segment
from x_c1 c left join x_scd1 u on c.customer_id = u.customer_id
union all
select customer_id, customer_number, customer_name, segment from x_new_customers
""")

cte("x_close", """
select a.address_id, a.valid_from as old_from, min(s.eff_from) as new_from
from x_a2 a join x_c2 c on a.customer_id = c.customer_id join x_delta s on s.customer_id = c.customer_number
where s.is_new_version and a.is_current
  and (a.region is distinct from s.region or a.state is distinct from s.state or a.city is distinct from s.city
       or a.postal_code is distinct from s.postal_code or a.country is distinct from s.country)
group by a.address_id, a.valid_from
""")

cte("x_close_to", """
select address_id, case when new_from - 1 <= old_from then old_from else new_from - 1 end as valid_to from x_close
""")

cte("x_a3", """
select a.address_id, a.customer_id, a.country, a.city, a.state, a.postal_code, a.region, a.valid_from,
       case when k.address_id is not null then k.valid_to else a.valid_to end as valid_to,
       case when k.address_id is not null then false else a.is_current end as is_current
from x_a2 a left join x_close_to k on a.address_id = k.address_id
""")

cte("x_new_versions", """
select (select max(address_id) from x_a3) + row_number() over (order by customer_id, country nulls last, city nulls last, state nulls last, postal_code nulls last, region nulls last, valid_from nulls last) as address_id,
       customer_id, country, city, state, postal_code, region, valid_from, cast(null as date) as valid_to, true as is_current
from (select distinct c.customer_id, s.country, s.city, s.state, s.postal_code, s.region, s.eff_from as valid_from
      from x_delta s join x_c2 c on s.customer_id = c.customer_number
      where not exists (select 1 from x_a3 a where a.customer_id = c.customer_id and a.is_current
                          and a.region is not distinct from s.region and a.state is not distinct from s.state
                          and a.city is not distinct from s.city and a.postal_code is not distinct from s.postal_code)) t
""")

cte("x_a4", """
select * from x_a3 union all select * from x_new_versions
""")

cte("x_new_products", """
select (select max(product_id) from x_p1) + row_number() over (order by product_number) as product_id,
       product_number, product_name, category, sub_category
from (select product_id as product_number, product_name, category, sub_category,
             row_number() over (partition by product_id order by product_name nulls last, category nulls last, sub_category nulls last) as rn
      from delta_orders d where not exists (select 1 from x_p1 p where p.product_number = d.product_id)) t
where rn = 1
""")

cte("x_p2", """
select * from x_p1 union all select * from x_new_products
""")

cte("x_next_batch", """
select coalesce(max(batch_id), 1) + 1 as batch_id from x_o1
""")

cte("x_new_orders", """
select (select max(order_id) from x_o1) + row_number() over (order by order_number) as order_id,
       customer_id, order_number, order_date, ship_date, ship_mode, (select batch_id from x_next_batch) as batch_id
from (select customer_id, order_number, order_date, ship_date, ship_mode,
             row_number() over (partition by order_number order by customer_id nulls last, order_date nulls last, ship_date nulls last, ship_mode nulls last) as rn
      from (select c.customer_id, s.order_id as order_number, try_cast(s.order_date as date) as order_date,
                   greatest(try_cast(s.ship_date as date), try_cast(s.order_date as date)) as ship_date, s.ship_mode
            from delta_orders s join x_c2 c on s.customer_id = c.customer_number
            where not exists (select 1 from x_o1 o where o.order_number = s.order_id)) u) t
where rn = 1
""")

cte("x_o2", """
select * from x_o1 union all select * from x_new_orders
""")

cte("x_new_details", """
select (select max(order_detail_id) from x_d1) + row_number() over (order by order_id, product_id, sales nulls last, quantity nulls last, discount nulls last, profit nulls last) as order_detail_id,
       order_id, product_id, sales, quantity, discount, profit
from (select o.order_id, p.product_id, s.sales, case when s.quantity = 0 then 1 else s.quantity end as quantity, s.discount, s.profit
      from delta_orders s join x_o2 o on s.order_id = o.order_number join x_p2 p on s.product_id = p.product_number
      where not exists (select 1 from x_d1 d where d.order_id = o.order_id and d.product_id = p.product_id)) t
""")

cte("x_d2", """
select * from x_d1 union all select * from x_new_details
""")

cte("x_d1_pairs", """
select distinct order_id, product_id from x_d1
""")

# -------------------------------------------------------------- correction
cte("x_corr_targets", """
select order_id from x_o2
where order_date between date '2000-01-01' and date '2000-12-31' and order_number like 'ORD-1%'
""")

cte("x_corr_doomed", """
select order_detail_id from x_d2
where order_id in (select order_id from x_corr_targets)
  and ('0x' || substr(md5(cast(order_detail_id as varchar)), 1, 4))::INT % 100 >= 20
""")

cte("x_d3", """
select * from x_d2 where order_detail_id not in (select order_detail_id from x_corr_doomed)
""")

cte("x_corr_orphans", """
select order_id from x_o2
where order_date between date '2000-01-01' and date '2000-12-31'
  and order_id not in (select distinct order_id from x_d3)
""")

cte("x_o3", """
select * from x_o2 where order_id not in (select order_id from x_corr_orphans)
""")

# ------------------------------------------------------------------- mart
cte("x_dim_products", """
select product_id, product_number, product_name, category, sub_category from x_p2
""")

cte("x_dim_customers", """
select c.customer_id, c.customer_number, c.customer_name, c.segment, a.country, a.city, a.state, a.region, a.postal_code
from x_c2 c join (select *, row_number() over (partition by customer_id order by valid_from desc, address_id desc) as rn
                  from x_a4 where is_current) a on c.customer_id = a.customer_id
where a.rn = 1
""")

cte("x_fact", """
select d.order_detail_id, o.order_id, o.order_number, o.order_date, o.ship_date, o.ship_mode, o.customer_id, d.product_id,
       a.country as sales_country, a.region as sales_region, a.state as sales_state, a.city as sales_city,
       d.sales, d.quantity, d.discount, d.profit
from x_d2 d join x_o2 o on d.order_id = o.order_id
left join x_a4 a on o.customer_id = a.customer_id and o.order_date >= a.valid_from and (a.valid_to is null or o.order_date <= a.valid_to)
""")

cte("x_fact_unique", """
select order_detail_id, order_id, order_number, order_date, ship_date, ship_mode, customer_id, product_id,
       sales_country, sales_region, sales_state, sales_city, sales, quantity, discount, profit
from (select d.order_detail_id, o.order_id, o.order_number, o.order_date, o.ship_date, o.ship_mode, o.customer_id, d.product_id,
             a.country as sales_country, a.region as sales_region, a.state as sales_state, a.city as sales_city,
             d.sales, d.quantity, d.discount, d.profit,
             row_number() over (partition by d.order_detail_id order by a.valid_from desc nulls last, a.address_id desc nulls last) as rn
      from x_d2 d join x_o2 o on d.order_id = o.order_id
      left join x_a4 a on o.customer_id = a.customer_id and o.order_date >= a.valid_from and (a.valid_to is null or o.order_date <= a.valid_to)) t
where rn = 1
""")

cte("x_calendar", """
select cast(d as date) as date, year(cast(d as date)) as year, quarter(cast(d as date)) as quarter,
       month(cast(d as date)) as month, cast(date_trunc('month', cast(d as date)) as date) as month_start
from (select unnest(generate_series(cast(date_trunc('year', min(order_date)) as timestamp),
                                    cast(date_trunc('year', max(order_date)) as timestamp) + interval 1 year - interval 1 day,
                                    interval 1 day)) as d
      from x_fact) t
""")

cte("x_daily", """
select order_date as date, sum(sales) as day_sales from x_fact group by order_date
""")

cte("x_monthly", """
select cast(date_trunc('month', order_date) as date) as month_start, sum(sales) as total_sales from x_fact group by 1
""")

cte("x_yearly", """
select year(order_date) as year, sum(sales) as total_sales from x_fact group by 1
""")

cte("x_customer_totals", """
select customer_id, sum(sales) as total_sales, sum(profit) as total_profit, count(distinct order_id) as order_count
from x_fact group by customer_id
""")

# ------------------------------------------------------------------ audit
cte("x_audit_initial", """
select cast(1 as bigint) as load_id, 'INITIAL' as load_type, 'stage.raw_orders' as source_table,
       cast(count(*) as bigint) as rows_processed, 'COMPLETED' as status,
       cast(0 as bigint) as rows_inserted, cast(0 as bigint) as rows_updated, cast(0 as bigint) as rows_skipped
from x_d1
""")

cte("x_audit_secondary", """
select cast(2 as bigint) as load_id, 'SECONDARY' as load_type, 'stage.delta_orders' as source_table,
       cast(i.n as bigint) as rows_processed, 'COMPLETED' as status, cast(i.n as bigint) as rows_inserted,
       cast(u1.n + u2.n as bigint) as rows_updated, cast(s.n - i.n as bigint) as rows_skipped
from (select count(*) as n from x_new_orders) i, (select count(*) as n from x_scd1) u1,
     (select count(*) as n from x_close) u2, (select count(*) as n from delta_orders) s
""")

cte("x_audit_log", """
select * from x_audit_initial union all select * from x_audit_secondary
""")
