"""One-row-per-key selection with explicit, total orders.

Postgres' ``SELECT DISTINCT … ON CONFLICT DO NOTHING`` and ``DISTINCT ON`` keep an
unspecified survivor; here the survivor is always defined by an ordering so
every engine picks the same row. ``row_number() = 1`` is planned by Spark as a
partial WindowGroupLimit *before* the shuffle, so a hot key is cut down to one
candidate per map task before it is moved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import asc_last, desc_last


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order_cols`` (descending, NULLs last) per key."""
    return first_per_key(df, keys, desc_last(*order_cols))


def first_wins(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-if-absent survivor: per key, the row whose remaining columns sort
    first (ascending, NULLs last)."""
    rest = [c for c in df.columns if c not in keys]
    return first_per_key(df, keys, asc_last(*rest))


def insert_ignore(existing_keys: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` whose key is not yet present (ON CONFLICT DO NOTHING),
    one survivor per key."""
    fresh = first_wins(incoming, [key])
    return fresh.join(existing_keys.select(key), key, "left_anti")


def keep_newest_flags(df: DataFrame, key: str, id_col: str, order_cols: Sequence[str]) -> DataFrame:
    """Ids of rows that are *not* the newest of their key.

    Skew-safe form of ``row_number() … > 1``: the newest row per key is found by
    an aggregate (map-side combined), then the rest are taken with an anti join
    on the unique id, so no key's rows are ever gathered into one task.
    """
    newest = (df.groupBy(key)
              .agg(F.max(F.struct(*[F.col(c) for c in order_cols], F.col(id_col))).alias("_w"))
              .select(F.col(f"_w.{id_col}").alias(id_col)))
    return df.select(id_col).join(newest, id_col, "left_anti")
