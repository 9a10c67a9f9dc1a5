"""Registered queries: time intelligence by group."""

from __future__ import annotations

from ledgerloom.operators import mart
from ledgerloom.operators import measures as m
from ledgerloom.operators import time_intelligence as ti
from ledgerloom.plans.oracle import cte
from ledgerloom.plans.queries_reports import syoy
from ledgerloom.plans.registry import register
from ledgerloom.plans.warehouse_run import warehouse as W

GROUP = ["category", "sales_state"]

cte("x_fact_category", """
select p.category, f.sales_state, f.order_date, f.sales from x_fact f join x_dim_products p on f.product_id = p.product_id
""")

cte("x_group_daily", """
select category, sales_state, order_date as date, sum(sales) as day_sales from x_fact_category group by all
""")

def _period_cte(name: str, grain: str) -> None:
    cte(name, f"""
select category, sales_state, cast(date_trunc('{grain}', date) as date) as period, sum(day_sales) as total_sales
from x_group_daily group by all
""")


for _grain in ("month", "quarter", "year"):
    _period_cte(f"x_group_{_grain}", _grain)


def _same_period_sql(source: str, grain: str, extra: str = "") -> str:
    """Every calendar period with the group's own sales, and those of the period twelve months before."""
    return f"""
select category, sales_state, cast(period as varchar) as period, cast(total as double) as total_sales, cast(before as double) as sales_sply{extra}
from (select category, sales_state, period, max(now) as total, max(before) as before
      from (select category, sales_state, period, total_sales as now, null as before from {source}
            union all
            select l.category, l.sales_state, p.period, null, l.total_sales
            from {source} l join (select distinct cast(date_trunc('{grain}', date) as date) as period from x_calendar) p
              on l.period = cast(p.period - interval 12 month as date)) u
      group by all) t"""


cte("x_group_day", "select category, sales_state, date as period, day_sales as total_sales from x_group_daily")


def _fact(spark, sf):
    w = W(spark, sf)
    return w.fact_sales().join(w.dim_products().select("product_id", "category", "sub_category"), "product_id")


def _calendar(spark, sf):
    return mart.calendar(m.daily_sales(W(spark, sf).fact_sales()), "date")


def _ytd_sql(group: str) -> str:
    """The running sum of a year over every calendar day from the group's first sale in it."""
    daily = f"(select {group} as g, order_date as date, sum(sales) as day_sales from x_fact f join x_dim_products p on f.product_id = p.product_id group by all)"
    return f"""
select d.g as {group.split('.')[-1]}, cast(c.date as varchar) as date, cast(x.day_sales as double) as total_sales,
       cast(sum(coalesce(x.day_sales, 0)) over (partition by d.g, d.year order by c.date) as double) as sales_ytd
from (select g, year(date) as year, min(date) as first_day from {daily} group by all) d
join x_calendar c on c.year = d.year and c.date >= d.first_day
left join {daily} x on x.g is not distinct from d.g and x.date = c.date"""


@register("sales_ytd_by_state", _ytd_sql("f.sales_state"))
def sales_ytd_by_state(spark, sf):
    """TOTALYTD per state of the sale and day, days without sales included."""
    # Every line of the fact has its product (the lines were joined to it), so a sum by state needs no dimension.
    return ti.year_to_date(W(spark, sf).fact_sales(), ["sales_state"], _calendar(spark, sf))


@register("sales_ytd_by_subcategory", _ytd_sql("p.sub_category"))
def sales_ytd_by_subcategory(spark, sf):
    """TOTALYTD per sub-category and day."""
    return ti.year_to_date(_fact(spark, sf), ["sub_category"], _calendar(spark, sf))


@register("sales_sply_by_group", _same_period_sql("x_group_day", "day"))
def sales_sply_by_group(spark, sf):
    """SAMEPERIODLASTYEAR per category, state and day (29 Feb → 28 Feb)."""
    return ti.same_period_last_year(_fact(spark, sf), GROUP, _calendar(spark, sf), "day")


@register("sales_sply_monthly_by_group", _same_period_sql("x_group_month", "month"))
def sales_sply_monthly_by_group(spark, sf):
    """SAMEPERIODLASTYEAR per category, state and month."""
    return ti.same_period_last_year(_fact(spark, sf), GROUP, _calendar(spark, sf), "month")


@register("sales_yoy_quarterly_by_group", _same_period_sql(
    "x_group_quarter", "quarter", f", {syoy('total', 'before')} as sales_yoy"))
def sales_yoy_quarterly_by_group(spark, sf):
    """Growth on the same quarter last year per category and state."""
    return ti.year_over_year(_fact(spark, sf), GROUP, _calendar(spark, sf), "quarter")


@register("sales_yoy_by_group", _same_period_sql(
    "x_group_year", "year", f", {syoy('total', 'before')} as sales_yoy"))
def sales_yoy_by_group(spark, sf):
    """Growth on last year per category and state."""
    return ti.year_over_year(_fact(spark, sf), GROUP, _calendar(spark, sf), "year")
