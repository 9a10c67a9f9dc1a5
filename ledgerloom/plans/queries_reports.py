"""Registered queries over the mart: measures, time intelligence, report visuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import mart
from ledgerloom.operators import measures as m
from ledgerloom.operators import reports
from ledgerloom.plans.registry import register
from ledgerloom.plans.warehouse_run import warehouse as W

# Fixed report parameters.
BIG_BUYER_SALES = 100000.0          # customer sales from which a loss is flagged
RECEIPT_BIN_WIDTH = 250.0           # histogram bin ("0 to $250" is the first bin)
# The first customer that a load renamed: there is one at every size.
RENAMED_SQL = "select min(customer_name) from x_c2 where customer_name like '% (Updated)'"


def sdiv(num: str, den: str) -> str:
    """SQL form of DIVIDE(num, den, 0) over doubles."""
    return (f"case when cast({den} as double) is null or cast({den} as double) = 0 then 0.0 "
            f"else cast({num} as double) / cast({den} as double) end")


def syoy(cur: str, sply: str) -> str:
    return (f"case when cast({sply} as double) is null or cast({sply} as double) = 0 then 0.0 "
            f"else (coalesce(cast({cur} as double), 0.0) - cast({sply} as double)) / cast({sply} as double) end")


def _fact(spark, sf):
    return W(spark, sf).fact_sales()


def _calendar(fact):
    """The calendar from the fact's daily sums, the aggregate that the measures use too."""
    return mart.calendar(m.daily_sales(fact), "date")


def _cal(spark, sf):
    return _calendar(_fact(spark, sf))


@register("category_matrix", f"""
select p.category, p.sub_category, cast(grouping(p.category, p.sub_category) as bigint) as level,
       cast(sum(f.sales) as double) as total_sales, cast(sum(f.profit) as double) as total_profit,
       {sdiv('sum(f.profit)', 'sum(f.sales)')} as profit_margin,
       {sdiv('sum(f.sales)', '(select sum(sales) from x_fact)')} as pct_of_total
from x_fact f join x_dim_products p on f.product_id = p.product_id
group by rollup(p.category, p.sub_category)""")
def category_matrix(spark, sf):
    """Category → sub-category matrix with subtotals, margin and share."""
    w = W(spark, sf)
    return reports.category_matrix(w.fact_sales(), w.dim_products())


# ----------------------------------------------------------------- measures
@register("total_sales", "select cast(sum(sales) as double) as total_sales from x_fact")
def total_sales(spark, sf):
    """SUM(sales)."""
    return _fact(spark, sf).agg(m.total_sales())


@register("total_profit", "select cast(sum(profit) as double) as total_profit from x_fact")
def total_profit(spark, sf):
    """SUM(profit)."""
    return _fact(spark, sf).agg(m.total_profit())


@register("total_sales_iterative", """
select cast(sum(sales) as double) as total_sales_iterative,
       cast(sum(cast(sales as decimal(18,2)) * quantity) as double) as sales_times_quantity
from x_fact""")
def total_sales_iterative(spark, sf):
    """SUMX(fact, sales), plus a per-row product as the iterator's use case."""
    return _fact(spark, sf).agg(
        m.total_sales_iterative(),
        F.sum(F.col("sales").cast("decimal(18,2)") * F.col("quantity")).alias("sales_times_quantity"))


@register("profit_margin", f"""
select p.category, {sdiv('sum(f.profit)', 'sum(f.sales)')} as profit_margin
from x_fact f join x_dim_products p on f.product_id = p.product_id group by p.category""")
def profit_margin(spark, sf):
    """DIVIDE(profit, sales, 0) per category."""
    w = W(spark, sf)
    return reports.margin_by_category(w.fact_sales(), w.dim_products())


@register("calendar", """
select cast(date as varchar) as date, cast(year as bigint) as year, cast(quarter as bigint) as quarter,
       cast(month as bigint) as month, cast(month_start as varchar) as month_start
from x_calendar""")
def calendar(spark, sf):
    """Day spine over the fact's years."""
    return _cal(spark, sf)


@register("sales_ytd", """
select cast(c.date as varchar) as date, cast(d.day_sales as double) as total_sales,
       cast(sum(d.day_sales) over (partition by c.year order by c.date rows between unbounded preceding and current row) as double) as sales_ytd
from x_calendar c left join x_daily d on d.date = c.date""")
def sales_ytd(spark, sf):
    """TOTALYTD per calendar day."""
    f = _fact(spark, sf)
    return m.sales_ytd(f, _calendar(f))


@register("sales_sply", """
select cast(c.date as varchar) as date, cast(d.day_sales as double) as total_sales, cast(p.day_sales as double) as sales_sply
from x_calendar c left join x_daily d on d.date = c.date
left join x_daily p on p.date = cast(c.date - interval 12 month as date)""")
def sales_sply(spark, sf):
    """SAMEPERIODLASTYEAR at day grain (29 Feb → 28 Feb)."""
    f = _fact(spark, sf)
    return m.sales_sply_daily(f, _calendar(f))


@register("sales_yoy", f"""
select cast(y.year as bigint) as year, cast(c.total_sales as double) as total_sales,
       cast(p.total_sales as double) as sales_sply, {syoy('c.total_sales', 'p.total_sales')} as sales_yoy
from (select distinct year from x_calendar) y left join x_yearly c on c.year = y.year
left join x_yearly p on p.year + 1 = y.year""")
def sales_yoy(spark, sf):
    """(current − last year) / last year per year, 0 when last year is blank."""
    f = _fact(spark, sf)
    return m.yearly_yoy(f, _calendar(f))


@register("pct_of_total", f"""
select sales_region, cast(sum(sales) as double) as total_sales,
       {sdiv('sum(sales)', '(select sum(sales) from x_fact)')} as pct_of_total
from x_fact group by sales_region""")
def pct_of_total(spark, sf):
    """Share of the unfiltered grand total per sales region."""
    return m.pct_of_total(_fact(spark, sf), ["sales_region"])


# ---------------------------------------------------------------- visuals
@register("kpi_cards", f"""
select cast(sum(sales) as double) as total_sales, cast(sum(profit) as double) as total_profit,
       cast(sum(case when year(order_date) < (select max(year) from x_calendar) then sales end) as double) as sales_sply,
       {sdiv('sum(profit)', 'sum(sales)')} as profit_margin,
       {syoy('sum(sales)', 'sum(case when year(order_date) < (select max(year) from x_calendar) then sales end)')} as sales_yoy
from x_fact""")
def kpi_cards(spark, sf):
    """V1: sales, profit, margin and YoY in the grand-total context."""
    f = _fact(spark, sf)
    return m.kpi_cards(f, _calendar(f))


@register("sales_trend_vs_last_year", """
select cast(c.month_start as varchar) as month_start, cast(c.year as bigint) as year, cast(c.month as bigint) as month,
       cast(cur.total_sales as double) as total_sales, cast(p.total_sales as double) as sales_sply
from (select distinct month_start, year, month from x_calendar) c
left join x_monthly cur on cur.month_start = c.month_start
left join x_monthly p on p.month_start = cast(c.month_start - interval 12 month as date)""")
def sales_trend_vs_last_year(spark, sf):
    """V2: monthly sales against the same month last year."""
    f = _fact(spark, sf)
    return m.monthly_vs_last_year(f, _calendar(f))


@register("seasonality_by_month", """
select cast(month(order_date) as bigint) as month, cast(sum(sales) as double) as total_sales,
       cast(rank() over (order by sum(sales) desc) as bigint) as sales_rank
from x_fact group by month(order_date)""")
def seasonality_by_month(spark, sf):
    """V3: month-of-year totals ranked (peak and weak months)."""
    return reports.seasonality_by_month(_fact(spark, sf))


@register("sales_by_state", """
select sales_state, cast(sum(sales) as double) as total_sales, cast(sum(profit) as double) as total_profit
from x_fact group by sales_state""")
def sales_by_state(spark, sf):
    """V4: sales by the state valid at order time (historical geography)."""
    return reports.sales_by(_fact(spark, sf), "sales_state")


@register("sales_by_segment", f"""
select c.segment, cast(sum(f.sales) as double) as total_sales,
       {sdiv('sum(f.sales)', '(select sum(sales) from x_fact)')} as pct_of_total
from x_fact f left join x_dim_customers c on f.customer_id = c.customer_id group by c.segment""")
def sales_by_segment(spark, sf):
    """Segment share of total sales."""
    w = W(spark, sf)
    return reports.sales_by_segment(w.fact_sales(), w.dim_customers())


@register("decomposition_tree", """
select f.sales_region, p.category, cast(grouping(f.sales_region, p.category) as bigint) as level,
       cast(sum(f.sales) as double) as total_sales
from x_fact f join x_dim_products p on f.product_id = p.product_id
group by rollup(f.sales_region, p.category)""")
def decomposition_tree(spark, sf):
    """V7: total → region → category."""
    w = W(spark, sf)
    return reports.decomposition_tree(w.fact_sales(), w.dim_products())


@register("top10_products_by_profit", """
select cast(t.product_id as bigint) as product_id, cast(t.total_profit as double) as total_profit,
       cast(t.total_sales as double) as total_sales, p.product_name, p.category
from (select product_id, sum(profit) as total_profit, sum(sales) as total_sales from x_fact
      group by product_id order by total_profit desc, product_id limit 10) t
join x_dim_products p on p.product_id = t.product_id""")
def top10_products_by_profit(spark, sf):
    """Ten most profitable products."""
    w = W(spark, sf)
    return reports.top_products_by_profit(w.fact_sales(), w.dim_products(), 10)


@register("customer_profitability", f"""
select cast(t.customer_id as bigint) as customer_id, cast(t.total_sales as double) as total_sales,
       cast(t.total_profit as double) as total_profit, cast(t.order_count as bigint) as order_count,
       c.customer_name, c.segment,
       (t.total_profit < 0 and t.total_sales >= {BIG_BUYER_SALES}) as unprofitable_big_buyer
from x_customer_totals t left join x_dim_customers c on c.customer_id = t.customer_id""")
def customer_profitability(spark, sf):
    """V9: sales vs profit per customer with the loss-making big-buyer flag."""
    w = W(spark, sf)
    return reports.customer_profitability(w.fact_sales(), w.dim_customers(), BIG_BUYER_SALES)


@register("sales_profit_corr", """
select round(corr(cast(total_sales as double), cast(total_profit as double)), 6) as sales_profit_corr,
       cast(count(*) as bigint) as customers
from x_customer_totals""")
def sales_profit_corr(spark, sf):
    """V9: correlation of customer sales and profit."""
    return reports.sales_profit_corr(_fact(spark, sf))


@register("order_value_histogram", f"""
select cast(floor(cast(receipt as double) / {RECEIPT_BIN_WIDTH}) * {RECEIPT_BIN_WIDTH} as double) as bin_start,
       cast(count(*) as bigint) as order_count
from (select order_id, sum(sales) as receipt from x_fact group by order_id) t group by 1""")
def order_value_histogram(spark, sf):
    """Orders per receipt-value bin."""
    return reports.order_value_histogram(_fact(spark, sf), RECEIPT_BIN_WIDTH)


@register("customer_details", f"""
select cast(t.customer_id as bigint) as customer_id, cast(t.total_sales as double) as total_sales,
       cast(t.total_profit as double) as total_profit, cast(t.order_count as bigint) as order_count,
       c.customer_number, c.customer_name, c.segment, {sdiv('t.total_profit', 't.total_sales')} as profit_margin
from x_customer_totals t left join x_dim_customers c on c.customer_id = t.customer_id""")
def customer_details(spark, sf):
    """Per-customer figures."""
    w = W(spark, sf)
    return reports.customer_details(w.fact_sales(), w.dim_customers())


@register("orders_of_named_customer", f"""
select cast(order_date as varchar) as order_date, sales_region, cast(sales as double) as sales, order_number,
       cast(order_detail_id as bigint) as order_detail_id
from x_fact where customer_id = (select customer_id from x_c2 where customer_name = ({RENAMED_SQL}))""")
def orders_of_named_customer(spark, sf):
    """One customer's lines with the region valid at order time."""
    w = W(spark, sf)
    customers = w.final().customers
    renamed = customers.filter(F.col("customer_name").endswith(" (Updated)"))
    return reports.orders_of_named_customer(w.fact_sales(), customers,
                                            renamed.agg(F.min("customer_name")).first()[0])


@register("unprofitable_subcategories", f"""
select p.category, p.sub_category, cast(sum(f.sales) as double) as total_sales,
       cast(sum(f.profit) as double) as total_profit, {sdiv('sum(f.profit)', 'sum(f.sales)')} as profit_margin
from x_fact f join x_dim_products p on f.product_id = p.product_id
group by p.category, p.sub_category having {sdiv('sum(f.profit)', 'sum(f.sales)')} < 0""")
def unprofitable_subcategories(spark, sf):
    """Loss-making sub-categories (margin below 0)."""
    w = W(spark, sf)
    return reports.unprofitable_subcategories(w.fact_sales(), w.dim_products())
