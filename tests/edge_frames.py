"""Small hand-built frames in the stage and core shapes."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from ledgerloom.schemas import ADDRESSES, CUSTOMERS, DELTA_ORDERS, ORDER_DETAILS, ORDERS, PRODUCTS

D = dt.date

STAGE_DEFAULTS = dict(
    row_key="r", order_id="ORD-1", order_date="2000-01-01", ship_date="2000-01-02",
    ship_mode="1-URGENT", customer_id="CUST-1", customer_name="Ann", segment="BUILDING",
    country="USA", city="CITY_1", state="NATION_1", postal_code=10001, region="AMERICA",
    product_id="PROD-1", category="SMALL", sub_category="Brand#1", product_name="bolt",
    sales=Decimal("10.00"), quantity=1, discount=Decimal("0.00"), profit=Decimal("1.00"),
    valid_from="", valid_to="", previous_region="", is_new_version=False,
    scd2_attribute_changed="",
)

CORE_TYPES = {
    "customers": T.StructType([T.StructField("customer_id", T.LongType()),
                               T.StructField("customer_number", T.StringType()),
                               T.StructField("customer_name", T.StringType()),
                               T.StructField("segment", T.StringType())]),
    "addresses": T.StructType([T.StructField("address_id", T.LongType()),
                               T.StructField("customer_id", T.LongType()),
                               T.StructField("country", T.StringType()),
                               T.StructField("city", T.StringType()),
                               T.StructField("state", T.StringType()),
                               T.StructField("postal_code", T.IntegerType()),
                               T.StructField("region", T.StringType()),
                               T.StructField("valid_from", T.DateType()),
                               T.StructField("valid_to", T.DateType()),
                               T.StructField("is_current", T.BooleanType())]),
    "products": T.StructType([T.StructField("product_id", T.LongType()),
                              T.StructField("product_number", T.StringType()),
                              T.StructField("product_name", T.StringType()),
                              T.StructField("category", T.StringType()),
                              T.StructField("sub_category", T.StringType())]),
    "orders": T.StructType([T.StructField("order_id", T.LongType()),
                            T.StructField("customer_id", T.LongType()),
                            T.StructField("order_number", T.StringType()),
                            T.StructField("order_date", T.DateType()),
                            T.StructField("ship_date", T.DateType()),
                            T.StructField("ship_mode", T.StringType()),
                            T.StructField("batch_id", T.IntegerType())]),
    "order_details": T.StructType([T.StructField("order_detail_id", T.LongType()),
                                   T.StructField("order_id", T.LongType()),
                                   T.StructField("product_id", T.LongType()),
                                   T.StructField("sales", T.DecimalType(10, 2)),
                                   T.StructField("quantity", T.IntegerType()),
                                   T.StructField("discount", T.DecimalType(5, 2)),
                                   T.StructField("profit", T.DecimalType(10, 2))]),
}
COLUMNS = {"customers": CUSTOMERS, "addresses": ADDRESSES, "products": PRODUCTS,
           "orders": ORDERS, "order_details": ORDER_DETAILS}


def stage(spark, rows: list[dict]):
    """Stage (delta-shaped) frame; unspecified columns take STAGE_DEFAULTS."""
    data = [tuple({**STAGE_DEFAULTS, **r}[f.name] for f in DELTA_ORDERS.fields) for r in rows]
    return spark.createDataFrame(data, DELTA_ORDERS)


def core(spark, table: str, rows: list[dict]):
    schema = CORE_TYPES[table]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def address(address_id, customer_id, valid_from, valid_to=None, is_current=True, **attrs):
    base = dict(country="USA", city="CITY_1", state="NATION_1", postal_code=10001,
                region="AMERICA")
    base.update(attrs)
    return dict(address_id=address_id, customer_id=customer_id, valid_from=valid_from,
                valid_to=valid_to, is_current=is_current, **base)
