"""Stage batches derived from the given tables.

``raw_orders`` is the initial flat batch and ``delta_orders`` the incremental
batch with its four scenario parts (new lines, exact duplicates, SCD1 renames,
SCD2 moves). The derivation rules are the fixture rules of FIXTURES.md; the
same rules are written in SQL in :mod:`ledgerloom.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.cleaning import union_aligned
from ledgerloom.operators.dedupe import latest_per_key
from ledgerloom.schemas import DELTA_COLUMNS, RAW_COLUMNS
from ledgerloom.sources.tables import read_table

# Fixed values of the scenario rules.
DELTA_START = "2000-01-01 00:00:00"       # orders from here on arrive in the delta
NEW_CUSTOMER_MOD = 13                      # customers seen only in the delta
DUPLICATE_ORDER_MOD = 50                   # initial lines re-sent unchanged
SCD1_CUSTOMER_MOD = 11                     # renamed customers (line 1 only)
SCD2_CUSTOMER_MOD = 7                      # customers that move region
SCD2_CONFLICT_MOD = 21                     # moves dated before their history
ZERO_QTY_ORDER_MOD = 29                    # new lines arriving with quantity 0
NEW_PRODUCT_MOD = 97                       # products seen only in the delta
LOSS_BRAND = "Brand#11"                    # sold below cost
NO_DISCOUNT_ORDER_MOD = 41                 # orders that name no discount
HELPER_COLUMNS = ["k_order", "k_cust", "k_line", "k_region", "k_part"]


def _ntz(text: str) -> Column:
    """A TIMESTAMP_NTZ literal: compares with the tables' timestamp_ntz columns
    without any time-zone conversion (a Python datetime literal would be
    zone-dependent), and still reaches the Parquet filter."""
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def _kept_columns() -> list[Column]:
    """The columns of a flat line that no other gives."""
    e = F.expr
    return [
        F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.col("o_date").cast("string").alias("order_date"),
        F.col("l_date").cast("string").alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        F.col("c_name").alias("customer_name"),
        F.when(F.col("o_custkey") % 19 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("segment"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        e("cast(cast(l_price as decimal(10,2)) * (1 - cast(l_cut as decimal(5,2)))"
          " as decimal(10,2))").alias("sales"),
        F.col("l_count").cast("int").alias("quantity"),
        F.when(F.col("o_orderkey") % NO_DISCOUNT_ORDER_MOD == 0, F.lit(None))
         .otherwise(F.col("l_cut")).cast("decimal(5,2)").alias("discount"),
        e("cast(cast(l_price as decimal(10,2)) * (cast(0.30 as decimal(5,2))"
          " - cast(l_cut as decimal(5,2))) - cast(l_count as int) * p_size"
          f" * case when p_brand = '{LOSS_BRAND}' then 40 else 4 end"
          " as decimal(10,2))").alias("profit"),
        F.col("o_orderkey").alias("k_order"),
        F.col("o_custkey").alias("k_cust"),
        F.col("l_linenumber").alias("k_line"),
        F.col("r_regionkey").alias("k_region"),
        F.col("l_partkey").alias("k_part"),
        F.col("l_suppkey").alias("k_supp"),
    ]


def _derived_columns() -> dict[str, Column]:
    """The columns of a flat line that its numbered keys give."""
    return {
        "row_key": F.concat_ws("-", *[F.col(c).cast("string") for c in ("k_order", "k_line", "k_part", "k_supp")]),
        "customer_id": F.concat(F.lit("CUST-"), F.col("k_cust").cast("string")),
        "country": F.lit("USA"),
        "city": F.concat(F.lit("CITY_"), F.when(F.col("k_cust") % 5 == 0, F.col("k_order") % 2)
                         .otherwise(F.col("k_cust") % 40).cast("string")),
        "postal_code": F.when(F.col("k_cust") % 17 == 0, F.lit(None).cast("int"))
                        .otherwise((F.lit(10000) + F.col("k_cust") % 900).cast("int")),
        "product_id": F.concat(F.lit("PROD-"), F.col("k_part").cast("string")),
    }


def full_lines(kept: DataFrame) -> DataFrame:
    """Flat lines with all their columns, from those that are kept of them."""
    derived = _derived_columns()
    return kept.select(*[derived[c].alias(c) if c in derived else F.col(c)
                         for c in [*RAW_COLUMNS, *HELPER_COLUMNS]])


def fx_lines(spark: SparkSession, sf_dir: str, order_filter: Column | None = None) -> DataFrame:
    """One flat line per lineitem, joined out to customer geography and product (see ``kept_lines``)."""
    return full_lines(kept_lines(spark, sf_dir, order_filter))


def kept_lines(spark: SparkSession, sf_dir: str, order_filter: Column | None = None) -> DataFrame:
    """Every flat line by the columns that no other gives.

    ``order_filter`` is a predicate on the raw ``orders`` columns; it is applied
    before the join so it reaches the orders scan (and, by the join's equality,
    is not re-evaluated per line).
    """
    orders = read_table(spark, sf_dir, "orders")
    if order_filter is not None:
        orders = orders.filter(order_filter)
    lines = read_table(spark, sf_dir, "lineitem")
    customer = read_table(spark, sf_dir, "customer")
    part = read_table(spark, sf_dir, "part")
    # Whether a side is broadcast is left to Spark, which checks its size.
    geo = (read_table(spark, sf_dir, "nation")
           .join(read_table(spark, sf_dir, "region"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    # The dimensions are joined before the two largest tables meet: customers to
    # orders (a quarter of the lines), parts to the lines while these are narrow.
    # When a dimension outgrows a broadcast, no flat line is shuffled for it.
    headers = (orders.join(customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey")),
                           F.col("o_custkey") == F.col("c_custkey"))
               .select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_date"), "o_orderpriority",
                       "c_name", "c_mktsegment", "n_name", "r_name", "r_regionkey"))
    # Lines travel as dates and whole numbers of cents, which the shuffle packs far better than
    # timestamps and doubles, and with one copy of each join key. The types are wide enough
    # for any line; the narrow ones are checked on joined lines only.
    narrow = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("l_date"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("l_price"), F.col("l_discount").cast("decimal(18,2)").alias("l_cut"),
        F.col("l_quantity").cast("long").alias("l_count"))
    parts = (narrow.join(part, F.col("l_partkey") == F.col("p_partkey"))
             .select(*narrow.columns, "p_type", "p_brand", "p_name", "p_size"))
    # lineitem ⋈ orders joins the two largest tables: a shuffle (sort-merge)
    # join on the order key, as it would be at any real size. Stating it also
    # keeps small inputs from running the whole line pipeline in as few tasks
    # as the lineitem file has row groups.
    flat = parts.join(headers.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return flat.select(*_kept_columns())


def raw_orders(spark: SparkSession, sf_dir: str, with_helpers: bool = True) -> DataFrame:
    """Initial batch: lines before the delta start, minus delta-only customers and products."""
    df = (fx_lines(spark, sf_dir,
                   (F.col("o_orderdate") < _ntz(DELTA_START))
                   & (F.col("o_custkey") % NEW_CUSTOMER_MOD != 0))
          .filter(F.col("k_part") % NEW_PRODUCT_MOD != 0))
    return df if with_helpers else df.drop(*HELPER_COLUMNS)


def stage_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flat line tagged with the stage batch it belongs to
    (``stage_part`` = ``initial`` or ``delta``). Lines of delta-only customers
    and products arrive in the delta whatever their date: no line is left out.

    One pass over lineitem serves both batches; a writer partitions by
    ``stage_part`` so each batch is a folder of its own.
    """
    return fx_lines(spark, sf_dir).withColumn("stage_part", _stage_part())


def _stage_part() -> Column:
    in_initial = ((F.col("order_date") < F.lit(DELTA_START[:10]))
                  & (F.col("k_cust") % NEW_CUSTOMER_MOD != 0)
                  & (F.col("k_part") % NEW_PRODUCT_MOD != 0))
    return F.when(in_initial, F.lit("initial")).otherwise(F.lit("delta"))


def tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`stage_lines` by the columns that a snapshot keeps; :func:`full_lines` gives the others."""
    return kept_lines(spark, sf_dir).withColumn("stage_part", _stage_part())


def _delta_row(df: DataFrame, *, row_key: Column | None = None, order_id: Column | None = None,
               order_date: Column | None = None, ship_date: Column | None = None,
               customer_name: Column | None = None, region: Column | None = None,
               sales: Column | None = None, quantity: Column | None = None,
               valid_from: Column | None = None, previous_region: Column | None = None,
               is_new_version: Column | None = None, changed: Column | None = None) -> DataFrame:
    over = {
        "row_key": row_key, "order_id": order_id, "order_date": order_date,
        "ship_date": ship_date, "customer_name": customer_name, "region": region,
        "sales": sales, "quantity": quantity,
    }
    cols = [(over[c] if over.get(c) is not None else F.col(c)).alias(c) for c in RAW_COLUMNS]
    extra = [
        (valid_from if valid_from is not None else F.col("order_date")).alias("valid_from"),
        F.lit("").alias("valid_to"),
        (previous_region if previous_region is not None else F.lit("")).alias("previous_region"),
        (is_new_version if is_new_version is not None else F.lit(False)).alias("is_new_version"),
        (changed if changed is not None else F.lit("")).alias("scd2_attribute_changed"),
    ]
    return df.select(*cols, *extra)


def delta_orders(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None,
                 new_lines: DataFrame | None = None) -> DataFrame:
    """Incremental batch (stage.delta_orders shape) built from four scenario parts."""
    return union_aligned(delta_parts(spark, sf_dir, raw, new_lines), DELTA_COLUMNS, {})


def delta_parts(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None,
                new_lines: DataFrame | None = None) -> list[DataFrame]:
    """New lines, exact duplicates, renames and moves.

    ``raw`` is the initial batch with its helper columns and ``new_lines`` the
    flat lines that are not in it (e.g. the two folders of a
    :func:`stage_lines` snapshot); both are derived from the tables when not
    given."""
    if new_lines is None:
        new_lines = stage_lines(spark, sf_dir).filter("stage_part = 'delta'")
    part_new = _delta_row(
        new_lines,
        quantity=F.when(F.col("k_order") % ZERO_QTY_ORDER_MOD == 0, F.lit(0))
                  .otherwise(F.col("quantity")),
        is_new_version=(F.col("k_cust") % NEW_CUSTOMER_MOD == 0))

    raw = raw if raw is not None else raw_orders(spark, sf_dir)
    part_dup = _delta_row(raw.filter(F.col("k_order") % DUPLICATE_ORDER_MOD == 0))
    part_scd1 = _delta_row(
        raw.filter((F.col("k_cust") % SCD1_CUSTOMER_MOD == 0) & (F.col("k_line") == 1)),
        row_key=F.concat(F.lit("S1-"), F.col("row_key")),
        customer_name=F.concat(F.col("customer_name"), F.lit(" (Updated)")),
        sales=F.expr("cast(sales * 1.1 as decimal(10,2))"))

    # Last known line of each moving customer (skew-safe top-1 per key).
    movers = latest_per_key(
        raw.filter(F.col("k_cust") % SCD2_CUSTOMER_MOD == 0), ["customer_id"],
        ["order_date", "row_key", "sales", "ship_date", "order_id", "product_id"])
    region = read_table(spark, sf_dir, "region")
    moved = (movers.join(region,
                         F.col("r_regionkey") == (F.col("k_region") + 1) % 5)
             .withColumn("nd", F.when(F.col("k_cust") % SCD2_CONFLICT_MOD == 0,
                                      F.lit(dt.date(1995, 1, 1)))
                         .otherwise(F.date_add(F.lit(dt.date(2000, 1, 1)),
                                               (F.col("k_cust") % 200).cast("int")))))
    part_scd2 = _delta_row(
        moved,
        row_key=F.concat(F.lit("S2-"), F.col("row_key")),
        order_id=F.concat(F.lit("SCD2-"), F.col("order_id"), F.lit("-V2")),
        order_date=F.col("nd").cast("string"),
        ship_date=F.date_add(F.col("nd"), 3).cast("string"),
        region=F.col("r_name"),
        valid_from=F.col("nd").cast("string"),
        previous_region=F.col("region"),
        is_new_version=F.lit(True),
        changed=F.lit("region"))
    return [part_new, part_dup, part_scd1, part_scd2]
