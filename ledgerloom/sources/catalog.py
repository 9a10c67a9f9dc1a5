"""Tables and views by name: persisted view definitions, typed tables, intermediate results."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.operators.keys import KEPT
from ledgerloom.schemas import CORE
from ledgerloom.session import scratch_folder

FACT_FROM_LINE = ("order_detail_id", "product_id", "sales", "quantity", "discount", "profit")
FACT_FROM_ORDER = ("order_id", "order_number", "order_date", "ship_date", "ship_mode", "customer_id")
GEOGRAPHY = ("country", "region", "state", "city")


# -------------------------------------------------------------------- views

def _files_of(paths: list[str]) -> str:
    """Folders as one path pattern, from their longest common parent on."""
    if len(paths) == 1:
        return paths[0]
    parts = [p.split("/") for p in paths]
    same = 0
    while all(len(p) > same + 1 and p[same] == parts[0][same] for p in parts):
        same += 1
    return "/".join(parts[0][:same]) + "/{" + ",".join("/".join(p[same:]) for p in parts) + "}"


def core_view(table: str, paths: list[str]) -> str:
    """SQL of a core table over its folders, typed; no folders: no rows."""
    cols = ", ".join(f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in CORE[table].fields)
    if not paths:
        nulls = ", ".join(f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in CORE[table].fields)
        return f"select {nulls} where false"
    return f"select {cols} from parquet.`{_files_of(paths)}`"


def mart_views(prefix: str) -> dict[str, str]:
    """SQL of the three mart views over the views ``<prefix>core_*``."""
    core = f"{prefix}core_"
    product = ", ".join(CORE["products"].names)
    home = ("country", "city", "state", "region", "postal_code")
    now = ", ".join(f"h.now.{c} as {c}" for c in home)
    packed = ", ".join(f"'{c}', {c}" for c in home)
    line = ", ".join(f"l.{c}" for c in FACT_FROM_LINE)
    order = ", ".join(f"o.{c}" for c in FACT_FROM_ORDER)
    place = ", ".join(f"v.{c} as sales_{c}" for c in GEOGRAPHY)
    return {
        "dim_products": f"select {product} from {core}products",
        # The newest current address of each customer, highest id first among equals.
        "dim_customers": (
            f"select c.customer_id, c.customer_number, c.customer_name, c.segment, {now} from {core}customers c "
            f"join (select customer_id, max_by(named_struct({packed}), struct(valid_from, address_id)) as now "
            f"from {core}addresses where is_current group by customer_id) h using (customer_id)"),
        # Each line with every address version that was valid on its order's date.
        "fact_sales": (
            f"select {order}, {line}, {place} from {core}orders o join {core}order_details l using (order_id) "
            f"left join {core}addresses v on v.customer_id = o.customer_id "
            f"and o.order_date between v.valid_from and coalesce(v.valid_to, o.order_date)"),
    }


def create_views(spark: SparkSession, parts: Mapping[str, list[str]], prefix: str) -> list[str]:
    """Define or replace the core and mart views in the session catalog; returns their names.

    Definitions are SQL over files, so they outlive the frames they were made
    from and other sessions of the catalog can read them."""
    views = {f"core_{t}": core_view(t, parts[t]) for t in CORE if t in parts} | mart_views(prefix)
    for name, sql in views.items():
        spark.sql(f"create or replace view {prefix}{name} as {sql}")
    return [prefix + n for n in views]


# ------------------------------------------------------------- typed tables

class TypedTable:
    """A table of declared types in a folder: created empty, filled, truncated or made anew."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def create(self) -> TypedTable:
        """(Re)create the table without rows: what it held before is gone."""
        self.spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(self.path)
        return self

    truncate = create

    def insert(self, rows: DataFrame) -> TypedTable:
        """Append rows, each column as its declared type; a value that does not fit fails the insert."""
        rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields]).write.mode("append").options(**KEPT).parquet(self.path)
        return self

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


@contextmanager
def temp_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` computed once into a table named ``name``, which is dropped with its files at the end."""
    spark = df.sparkSession
    path = scratch_folder(spark, "temp")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.createOrReplaceTempView(name)
    try:
        yield table
    finally:
        spark.catalog.dropTempView(name)
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
