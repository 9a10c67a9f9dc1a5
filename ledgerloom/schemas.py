"""Table shapes of the three warehouse layers (stage, core, mart)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType()
MONEY, RATE = T.DecimalType(10, 2), T.DecimalType(5, 2)

# Flat order line as it arrives (dates still text). row_key stands in for the
# source row number.
RAW_ORDER_FIELDS = [
    ("row_key", S), ("order_id", S), ("order_date", S), ("ship_date", S), ("ship_mode", S),
    ("customer_id", S), ("customer_name", S), ("segment", S), ("country", S), ("city", S),
    ("state", S), ("postal_code", I), ("region", S), ("product_id", S), ("category", S),
    ("sub_category", S), ("product_name", S), ("sales", MONEY), ("quantity", I),
    ("discount", RATE), ("profit", MONEY),
]
DELTA_EXTRA_FIELDS = [
    ("valid_from", S), ("valid_to", S), ("previous_region", S), ("is_new_version", B),
    ("scd2_attribute_changed", S),
]

RAW_ORDERS = T.StructType([T.StructField(n, t, True) for n, t in RAW_ORDER_FIELDS])
DELTA_ORDERS = T.StructType([T.StructField(n, t, True)
                             for n, t in RAW_ORDER_FIELDS + DELTA_EXTRA_FIELDS])
RAW_COLUMNS = [n for n, _ in RAW_ORDER_FIELDS]
DELTA_COLUMNS = RAW_COLUMNS + [n for n, _ in DELTA_EXTRA_FIELDS]

# Source CSV header → stage column (the flat export's rename map).
CSV_HEADER = {
    "Row ID": "row_id", "Order ID": "order_id", "Order Date": "order_date",
    "Ship Date": "ship_date", "Ship Mode": "ship_mode", "Customer ID": "customer_id",
    "Customer Name": "customer_name", "Segment": "segment", "Country": "country",
    "City": "city", "State": "state", "Postal Code": "postal_code", "Region": "region",
    "Product ID": "product_id", "Category": "category", "Sub-Category": "sub_category",
    "Product Name": "product_name", "Sales": "sales", "Quantity": "quantity",
    "Discount": "discount", "Profit": "profit",
}

# Typed core, audit and mart inputs. Nullability is declared by NOT_NULL below.
CORE_FIELDS = {
    "customers": [("customer_id", L), ("customer_number", S), ("customer_name", S), ("segment", S)],
    "addresses": [("address_id", L), ("customer_id", L), ("country", S), ("city", S), ("state", S),
                  ("postal_code", I), ("region", S), ("valid_from", D), ("valid_to", D), ("is_current", B)],
    "products": [("product_id", L), ("product_number", S), ("product_name", S), ("category", S),
                 ("sub_category", S)],
    "orders": [("order_id", L), ("customer_id", L), ("order_number", S), ("order_date", D),
               ("ship_date", D), ("ship_mode", S), ("batch_id", I)],
    "order_details": [("order_detail_id", L), ("order_id", L), ("product_id", L), ("sales", MONEY),
                      ("quantity", I), ("discount", RATE), ("profit", MONEY)],
    "load_audit": [("load_id", L), ("load_type", S), ("source_table", S), ("rows_processed", L),
                   ("status", S), ("rows_inserted", L), ("rows_updated", L), ("rows_skipped", L)],
}
CORE = {t: T.StructType([T.StructField(n, k, True) for n, k in fields]) for t, fields in CORE_FIELDS.items()}
CUSTOMERS, ADDRESSES, PRODUCTS, ORDERS, ORDER_DETAILS, AUDIT = (
    CORE[t].names for t in ("customers", "addresses", "products", "orders", "order_details", "load_audit"))
# A persisted log also keeps when a load began and ended.
AUDIT_LOG = T.StructType([*CORE["load_audit"].fields, T.StructField("start_time", T.TimestampType()),
                          T.StructField("end_time", T.TimestampType())])
ADDRESS_ATTRS = ["country", "city", "state", "postal_code", "region"]

# Declared constraints, re-aimed as data-quality rules. these
# lists and the lengths below state the DDL's constraints.
NOT_NULL = {
    "customers": ["customer_id", "customer_number", "customer_name"],
    "addresses": ["address_id", "customer_id", "valid_from", "is_current"],
    "products": ["product_id", "product_number", "product_name"],
    "orders": ["order_id", "customer_id", "order_number", "order_date", "ship_date", "batch_id"],
    "order_details": ["order_detail_id", "order_id", "product_id", "sales", "quantity",
                      "discount", "profit"],
    "load_audit": ["load_id", "load_type", "source_table", "rows_processed"],
}
UNIQUE = {
    "customers": ["customer_id", "customer_number"],
    "addresses": ["address_id"],
    "products": ["product_id", "product_number"],
    "orders": ["order_id", "order_number"],
    "order_details": ["order_detail_id"],
    "load_audit": ["load_id"],
    "raw_orders": ["row_key"],
    "delta_orders": ["row_key"],
}
FOREIGN_KEYS = [
    ("addresses", "customer_id", "customers", "customer_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_details", "order_id", "orders", "order_id"),
    ("order_details", "product_id", "products", "product_id"),
]
STAGE_LENGTHS = {
    "order_id": 50, "order_date": 20, "ship_date": 20, "ship_mode": 50, "customer_id": 20,
    "customer_name": 100, "segment": 50, "country": 50, "city": 50, "state": 50, "region": 50,
    "product_id": 20, "category": 50, "sub_category": 50, "product_name": 200,
}
DELTA_LENGTHS = {"valid_from": 20, "valid_to": 20, "previous_region": 50, "scd2_attribute_changed": 50}
LENGTHS = {
    "raw_orders": STAGE_LENGTHS,
    "delta_orders": {**STAGE_LENGTHS, **DELTA_LENGTHS},
    "customers": {"customer_number": 50, "customer_name": 255, "segment": 100},
    "addresses": {"country": 100, "city": 100, "state": 100, "region": 100},
    "products": {"product_number": 50, "category": 100, "sub_category": 100},
    "orders": {"order_number": 50, "ship_mode": 100},
    "load_audit": {"load_type": 20, "source_table": 50, "status": 20},
}
