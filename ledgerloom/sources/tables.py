"""Readers for the given Parquet tables.

Each reader names the columns it needs so the scan's ReadSchema stays narrow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_shipdate"],
}


def table_path(sf_dir: str, name: str) -> str:
    """Path of one given table."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Read a given table with only the columns the operators use."""
    df = spark.read.parquet(table_path(sf_dir, name))
    cols = columns if columns is not None else TABLE_COLUMNS.get(name)
    return df.select(*cols) if cols else df
