"""File sources and sinks of the stage and mart layers.

Readers always take an explicit schema (never inference), so a scan is one
pass and types do not depend on the sampled rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.schemas import CSV_HEADER, RAW_ORDERS

LATIN1 = "ISO-8859-1"

# Source CSV layout: header names of the flat export, row id as text here
# (our row ids are composite keys).
SOURCE_CSV = T.StructType([
    T.StructField(header, (T.StringType() if name == "row_id" else
                           RAW_ORDERS[name].dataType if name in RAW_ORDERS.names else T.StringType()),
                  True)
    for header, name in CSV_HEADER.items()])
TO_SOURCE_HEADER = {("row_key" if v == "row_id" else v): k for k, v in CSV_HEADER.items()}
FROM_SOURCE_HEADER = {k: ("row_key" if v == "row_id" else v) for k, v in CSV_HEADER.items()}


def write_source_csv(df: DataFrame, path: str, encoding: str = LATIN1) -> None:
    """Flat export with the source header names."""
    cols = [df[c].alias(TO_SOURCE_HEADER[c]) for c in TO_SOURCE_HEADER]
    (df.select(*cols).write.mode("overwrite").option("header", True)
     .option("encoding", encoding).csv(path))


def read_source_csv(spark: SparkSession, path: str, encoding: str = LATIN1) -> DataFrame:
    """Header CSV in the given encoding, typed by the source schema, renamed to
    stage names. A field that does not parse fails the read instead of turning
    into NULL unnoticed."""
    df = (spark.read.schema(SOURCE_CSV).option("header", True).option("encoding", encoding)
          .option("mode", "FAILFAST").csv(path))
    return df.withColumnsRenamed(FROM_SOURCE_HEADER)


NULL_MARK = "\\N"


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV sink (UTF-8, header, no index). NULL is written as ``\\N`` so it
    stays distinct from the empty string on the way back."""
    (df.write.mode("overwrite").option("header", header).option("nullValue", NULL_MARK)
     .option("emptyValue", '""').csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             header: bool = True) -> DataFrame:
    """CSV with an explicit schema, ``\\N`` as NULL (the sink's convention)."""
    return (spark.read.schema(schema).option("header", header).option("nullValue", NULL_MARK)
            .option("emptyValue", "").option("mode", "FAILFAST").csv(path))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_csv_or(spark: SparkSession, path: str, schema: T.StructType, instead: DataFrame,
                header: bool = True) -> DataFrame:
    """The CSV at ``path``, or ``instead`` typed alike where there is no such file."""
    return read_csv(spark, path, schema, header) if exists(spark, path) else typed(instead, schema)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, each cast to its type (a value that does not fit fails)."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def write_stage(df: DataFrame, path: str, schema: T.StructType = RAW_ORDERS,
                mode: str = "overwrite") -> None:
    """Typed stage load: cast to the stage schema, then replace or append."""
    typed(df, schema).write.mode(mode).parquet(path)


def write_stage_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
                     schema: T.StructType = RAW_ORDERS, mode: str = "overwrite",
                     batch_size: int = 1000) -> None:
    """The same typed stage load into a database table: Spark's JDBC writer
    sends multi-row inserts of ``batch_size`` rows from every task. (Not
    exercised in this repository: no database server is available.)"""
    w = (typed(df, schema).write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batch_size))
    for k, v in properties.items():
        w = w.option(k, v)
    w.save()


def read_stage(spark: SparkSession, path: str, schema: T.StructType = RAW_ORDERS) -> DataFrame:
    """Typed stage table."""
    return spark.read.schema(schema).parquet(path)
