"""Stage cleaning and profiling: renames, schema alignment, coercion, repairs,
column profiles and duplicate counts. All single-pass column expressions or
one aggregate per frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Source header names → stage names (columns not in the map are kept)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def align_to(df: DataFrame, columns: Sequence[str], defaults: Mapping[str, Column]) -> DataFrame:
    """Add missing columns with their default and put columns in canonical order."""
    out = df
    for c in columns:
        if c not in out.columns:
            out = out.withColumn(c, defaults.get(c, F.lit(None)))
    return out.select(*columns)


def union_aligned(frames: Sequence[DataFrame], columns: Sequence[str],
                  defaults: Mapping[str, Column]) -> DataFrame:
    """Bag union of frames with different column sets (pandas concat)."""
    return reduce(lambda a, b: a.unionByName(b), [align_to(f, columns, defaults) for f in frames])


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.select(*[(F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults
                        else F.col(c)) for c in df.columns])


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column as (column_name, value) rows."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("x")).select("x.*")
    return long.filter(F.col("value").isNotNull()).distinct()


def profile_columns(df: DataFrame) -> DataFrame:
    """Non-null count per column (``info()`` / ``count()``), one aggregate pass."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return (agg.unpivot(["_rows"], list(df.columns), "column_name", "non_null")
            .select("column_name", "non_null", F.col("_rows").alias("row_count")))


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """pandas ``duplicated().sum()`` per key column: rows minus distinct values,
    where all NULLs count as one value."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in keys:
        aggs += [F.countDistinct(c).alias(f"{c}__d"),
                 F.max(F.col(c).isNull().cast("int")).alias(f"{c}__n")]
    a = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     (F.col("_rows") - F.col(f"{c}__d") - F.coalesce(F.col(f"{c}__n"), F.lit(0)))
                     .cast("long").alias("duplicates")) for c in keys]
    return a.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def unique_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """pandas ``nunique()`` per key column."""
    a = df.agg(*[F.countDistinct(c).alias(c) for c in keys])
    return a.unpivot([], list(keys), "column_name", "unique_values")


def deterministic_sample(df: DataFrame, key: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """Exactly ``n`` rows chosen by the md5 of a key (a seeded sample that every
    engine reproduces; ``ties`` order rows that share a key). A top-n, so each
    task forwards at most n rows."""
    return (df.withColumn("_h", F.md5(F.col(key).cast("string")))
            .orderBy("_h", key, *ties).limit(n).drop("_h"))
