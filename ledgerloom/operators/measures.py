"""BI measures as functions of ``(fact, group columns)``.

A measure is evaluated per filter context, so each takes any list of grouping
columns. Sums are exact decimals; ratios divide the two sums as doubles and
return the alternate result (0) on a NULL or zero denominator, like DIVIDE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import safe_divide


def total_sales() -> Column:
    """SUM(sales) as ``total_sales``."""
    return F.sum("sales").alias("total_sales")


def total_profit() -> Column:
    """SUM(profit) as ``total_profit``."""
    return F.sum("profit").alias("total_profit")


def total_sales_iterative(expr: Column | None = None) -> Column:
    """SUMX: sum of a per-row expression (one aggregate, no row loop)."""
    e = expr if expr is not None else F.col("sales")
    return F.sum(e).alias("total_sales_iterative")


def profit_margin(profit: str = "total_profit", sales: str = "total_sales") -> Column:
    """DIVIDE(profit, sales, 0) over two already-aggregated columns."""
    return safe_divide(profit, sales).alias("profit_margin")


def sales_and_profit(fact: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Sales, profit and margin per group (any grouping columns)."""
    return (fact.groupBy(*group_cols).agg(total_sales(), total_profit())
            .withColumn("profit_margin", safe_divide("total_profit", "total_sales")))


def totals_by(fact: DataFrame, *keys: str) -> DataFrame:
    """Sales and profit per key: what reports join dimensions to, instead of the fact."""
    return fact.groupBy(*keys).agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))


def grand_total(fact: DataFrame) -> DataFrame:
    """One-row frame with the unfiltered total (ALL(fact)); safe to broadcast."""
    return fact.agg(F.sum("sales").alias("_all_sales"))


def with_share(grouped: DataFrame, total: DataFrame, col: str = "total_sales",
               name: str = "pct_of_total") -> DataFrame:
    """% of total: divide by the total of the *unfiltered* fact (a one-row frame)."""
    return (grouped.crossJoin(F.broadcast(total))
            .withColumn(name, safe_divide(col, "_all_sales")).drop("_all_sales"))


def pct_of_total(fact: DataFrame, group_cols: Sequence[str],
                 filtered: DataFrame | None = None) -> DataFrame:
    """Share of each group in the grand total. ``filtered`` (default: the fact)
    is the caller's filtered context; the denominator ignores its filters."""
    ctx = filtered if filtered is not None else fact
    return with_share(ctx.groupBy(*group_cols).agg(total_sales()), grand_total(fact))


# ------------------------------------------------------------ time intelligence
# The calendar is a spine of days; sums are joined onto it so periods without
# sales keep their row (BLANK), and "same period last year" is a join on the
# shifted period, never a lag over rows (gaps would shift it).

def daily_sales(fact: DataFrame) -> DataFrame:
    """Sales per order date."""
    return fact.groupBy(F.col("order_date").alias("date")).agg(F.sum("sales").alias("day_sales"))


def sales_ytd(fact: DataFrame, cal: DataFrame) -> DataFrame:
    """TOTALYTD: per calendar day, the day's sales and the running sum since 1 Jan.
    The window is partitioned by year, so each year is one small task."""
    from pyspark.sql import Window
    w = (Window.partitionBy("year").orderBy("date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (cal.select("date", "year").join(daily_sales(fact), "date", "left")
            .select("date", F.col("day_sales").alias("total_sales"),
                    F.sum("day_sales").over(w).alias("sales_ytd")))


def sales_sply_daily(fact: DataFrame, cal: DataFrame) -> DataFrame:
    """SAMEPERIODLASTYEAR at day grain: 29 Feb maps to 28 Feb of the year before."""
    d = daily_sales(fact)
    prev = d.select(F.col("date").alias("prev_date"), F.col("day_sales").alias("sales_sply"))
    return (cal.select("date").join(d, "date", "left")
            .join(prev, F.add_months("date", -12) == F.col("prev_date"), "left")
            .select("date", F.col("day_sales").alias("total_sales"), "sales_sply"))


def monthly_vs_last_year(fact: DataFrame, cal: DataFrame) -> DataFrame:
    """Per calendar month: sales and sales of the same month a year before."""
    m = fact.groupBy(F.trunc("order_date", "month").alias("month_start")).agg(
        F.sum("sales").alias("total_sales"))
    prev = m.select(F.col("month_start").alias("prev_month"), F.col("total_sales").alias("sales_sply"))
    months = cal.select("month_start", "year", "month").distinct()
    return (months.join(m, "month_start", "left")
            .join(prev, F.add_months("month_start", -12) == F.col("prev_month"), "left")
            .select("month_start", "year", "month", "total_sales", "sales_sply"))


def yoy(cur: str = "total_sales", sply: str = "sales_sply") -> Column:
    """DIVIDE(cur − sply, sply, 0) with DAX blank arithmetic (BLANK − x = −x)."""
    s = F.col(sply).cast("double")
    return (F.when(s.isNull() | (s == 0), F.lit(0.0))
            .otherwise((F.coalesce(F.col(cur).cast("double"), F.lit(0.0)) - s) / s))


def yearly_yoy(fact: DataFrame, cal: DataFrame) -> DataFrame:
    """Per calendar year: sales, last year's sales (year − 1 joined, not lagged) and YoY."""
    y = fact.groupBy(F.year("order_date").alias("year")).agg(F.sum("sales").alias("total_sales"))
    prev = y.select((F.col("year") + 1).alias("year"), F.col("total_sales").alias("sales_sply"))
    return (cal.select("year").distinct().join(y, "year", "left").join(prev, "year", "left")
            .withColumn("sales_yoy", yoy()))


def kpi_cards(fact: DataFrame, cal: DataFrame) -> DataFrame:
    """Grand-total context: SPLY of the whole calendar is the calendar shifted
    back a year and intersected with itself, i.e. every year but the last."""
    daily = totals_by(fact, "order_date")      # one pass over the fact, one row a day
    last_year = cal.agg(F.max("year").alias("_last"))
    t = (daily.crossJoin(last_year)
         .agg(F.sum("sales").alias("total_sales"), F.sum("profit").alias("total_profit"),
              F.sum(F.when(F.year("order_date") < F.col("_last"), F.col("sales")))
              .alias("sales_sply")))
    return (t.withColumn("profit_margin", safe_divide("total_profit", "total_sales"))
            .withColumn("sales_yoy", yoy()))
