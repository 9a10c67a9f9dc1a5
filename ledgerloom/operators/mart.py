"""Star schema over the core layer: product and customer dimensions, the
point-in-time sales fact, and a calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.dedupe import latest_per_key
from ledgerloom.operators.point_in_time import latest_version

FACT_COLUMNS = ["order_detail_id", "order_id", "order_number", "order_date", "ship_date",
                "ship_mode", "customer_id", "product_id", "sales_country", "sales_region",
                "sales_state", "sales_city", "sales", "quantity", "discount", "profit"]


def dim_products(products: DataFrame) -> DataFrame:
    """Product dimension (the product table's business columns)."""
    return products.select("product_id", "product_number", "product_name", "category",
                           "sub_category")


def current_addresses(addresses: DataFrame) -> DataFrame:
    """Address versions flagged current."""
    return addresses.filter(F.col("is_current"))


def dim_customers(customers: DataFrame, addresses: DataFrame) -> DataFrame:
    """Customer with its newest current address (ties: highest address id).
    Customers without a current address are left out (inner join)."""
    newest = latest_per_key(current_addresses(addresses), ["customer_id"],
                            ["valid_from", "address_id"])
    return (customers.join(newest, "customer_id")
            .select("customer_id", "customer_number", "customer_name", "segment", "country",
                    "city", "state", "region", "postal_code"))


def orders_with_geography(orders: DataFrame, addresses: DataFrame) -> DataFrame:
    """Each order header LEFT JOIN the address versions valid on its date
    (both ends inclusive, open end = NULL). Overlapping versions fan out.

    A range join: besides the customer, the equi-key carries the order year.
    Each version is repeated for those years it covers in which its customer
    has orders, so an order only meets the versions overlapping its year
    instead of all versions of its customer, and a far date adds one year to
    one customer only; every matching pair still meets exactly once (an order
    has one year). Joined on headers, not lines, which are far fewer.
    """
    o = (orders.select("order_id", "order_number", "order_date", "ship_date", "ship_mode",
                       "customer_id")
         .withColumn("_year", F.year("order_date")).alias("o"))
    years = (orders.select("customer_id", F.year("order_date").alias("a_year")).distinct()
             .groupBy("customer_id").agg(F.collect_list("a_year").alias("_years")))
    covered = F.filter("_years", lambda y: (y >= F.year("valid_from"))
                       & (F.col("valid_to").isNull() | (y <= F.year("valid_to"))))
    a = (addresses.join(years, "customer_id")
         .select(F.col("customer_id").alias("a_customer"), "address_id", "valid_from",
                 "valid_to", F.col("country").alias("sales_country"),
                 F.col("region").alias("sales_region"), F.col("state").alias("sales_state"),
                 F.col("city").alias("sales_city"), F.explode(covered).alias("a_year"))
         .alias("a"))
    cond = ((F.col("o.customer_id") == F.col("a.a_customer"))
            & (F.col("o._year") == F.col("a.a_year"))
            & (F.col("o.order_date") >= F.col("a.valid_from"))
            & (F.col("a.valid_to").isNull() | (F.col("o.order_date") <= F.col("a.valid_to"))))
    return o.join(a, cond, "left").drop("a_customer", "a_year", "_year")


def _fact(details: DataFrame, headers: DataFrame) -> DataFrame:
    return details.join(headers, "order_id").select(*FACT_COLUMNS)


def fact_sales(details: DataFrame, orders: DataFrame, addresses: DataFrame) -> DataFrame:
    """Point-in-time sales fact: one row per line and matching address version (fan-out kept)."""
    return _fact(details, orders_with_geography(orders, addresses))


def fact_sales_unique(details: DataFrame, orders: DataFrame, addresses: DataFrame) -> DataFrame:
    """One row per line: among matching versions the latest ``valid_from`` (then
    highest address id) wins; no match keeps NULL geography. Found by a sorted
    sweep over headers and versions, which never fans out."""
    versions = addresses.select("customer_id", "address_id", "valid_from", "valid_to",
                                *[F.col(c).alias(f"sales_{c}") for c in ("country", "region", "state", "city")])
    headers = latest_version(orders.select("order_id", "order_number", "order_date", "ship_date", "ship_mode", "customer_id"),
                             versions, ["sales_country", "sales_region", "sales_state", "sales_city"])
    return _fact(details, headers)


def calendar(fact: DataFrame, date_col: str = "order_date") -> DataFrame:
    """One row per day over the fact's date range widened to whole years."""
    bounds = fact.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = bounds.select(F.explode(F.sequence(F.trunc("lo", "year"),
                                              F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1)
                                              )).alias("date"))
    return days.select("date", F.year("date").alias("year"), F.quarter("date").alias("quarter"),
                       F.month("date").alias("month"), F.trunc("date", "month").alias("month_start"))
