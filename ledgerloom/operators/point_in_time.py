"""The version valid at a date, by one sorted sweep instead of a range join.

Versions and headers are put in one order: owner, date, versions before headers.
Going through it, an owner's versions are stacked as they begin; a header takes
the topmost one that has not ended. Dates only go up, so a version found ended
is dropped for good and every version is pushed and popped once, however many
of them overlap.

The order is cut into ranges of (owner, date) with about as many headers each,
so an owner with a third of all headers is spread over many tasks. A version
that is still open where a range begins is carried into it: it is given to
every range that it reaches, which for nearly all versions is one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import shuffle_partitions

SPAN = 1 << 20                  # days that a place has room for: years -700 to 2800 around 1970
_HEADER, _VERSION = 1, 0


def _place(owner: Column, date: Column) -> Column:
    """Owner and date as one number in their order (null if either is)."""
    return owner * SPAN + F.datediff(date, F.lit("1970-01-01").cast("date")) + SPAN // 2


def borders(headers: DataFrame, owner: str, at: str, ranges: int) -> list[int]:
    """Places that cut the headers into about equal ranges (one number a range, from one aggregate)."""
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    cuts = headers.agg(F.percentile_approx(_place(F.col(owner), F.col(at)), shares, 20 * ranges).alias("c")).first()["c"]
    return sorted(set(cuts or []))


def latest_version(headers: DataFrame, versions: DataFrame, values: Sequence[str], owner: str = "customer_id",
                   at: str = "order_date", version_id: str = "address_id", ranges: int | None = None) -> DataFrame:
    """Every header with the ``values`` of its owner's version valid at its date.

    Names that begin with ``_`` are taken. Valid: ``valid_from`` <= date <= ``valid_to`` (null: open). Of several the
    latest ``valid_from`` wins, then the highest id; without any, or with a null
    owner or date, the values are null. Owner and id are integers.
    """
    spark = headers.sparkSession
    ranges = ranges or shuffle_partitions(spark)
    cuts = np.array(borders(headers, owner, at, ranges), np.int64)
    named = [f"_v{i}" for i in range(len(values))]
    kept = list(headers.columns)

    found = versions.where(F.col(owner).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(owner).cast("long").alias("_owner"), F.col("valid_from").alias("_date"), F.lit(_VERSION).alias("_kind"),
        F.col(version_id).cast("long").alias("_id"), F.col("valid_to").alias("_end"),
        *[F.col(v).alias(n) for v, n in zip(values, named)],
        _place(F.col(owner), F.col("valid_from")).alias("_from"),
        F.coalesce(_place(F.col(owner), F.col("valid_to")), (F.col(owner) + 1) * SPAN - 1).alias("_to"))

    def carried(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each version in its own range and in those where it is still open at the border."""
        for b in rows:
            first = np.searchsorted(cuts, b.column("_from").to_numpy(), side="right")
            last = np.maximum(first, np.searchsorted(cuts, b.column("_to").to_numpy(), side="right"))
            many = last - first + 1
            row = np.repeat(np.arange(len(first)), many)
            part = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            t = b.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*t.columns[:-2], pa.array(part, pa.int32())], [*t.schema.names[:-2], "_part"])

    shape = T.StructType([*found.schema.fields[:-2], T.StructField("_part", T.IntegerType())])
    found = found.mapInArrow(carried, shape)

    def range_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, place.to_numpy(np.int64), side="right").astype(np.int32))

    asked = headers.select("*", F.col(owner).cast("long").alias("_owner"), F.col(at).cast("date").alias("_date"), F.lit(_HEADER).alias("_kind"),
                           F.pandas_udf(range_of, T.IntegerType())(F.coalesce(_place(F.col(owner), F.col(at)), F.lit(0))).alias("_part"))
    both = asked.unionByName(found, allowMissingColumns=True)
    both = both.repartition(ranges, "_part").sortWithinPartitions("_part", "_owner", "_date", "_kind", "_id")

    def sweep(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple | None = None
        stack: list[tuple] = []
        for b in rows:
            cols = [b.column(c).to_pylist() for c in ("_part", "_owner", "_date", "_kind", "_end")]
            version = [b.column(n).to_pylist() for n in named]
            asked_rows, won = [], []
            for i, (part, who, day, kind, end) in enumerate(zip(*cols)):
                if (part, who) != here:
                    here, stack = (part, who), []
                if kind == _VERSION:
                    stack.append((end, tuple(v[i] for v in version)))
                    continue
                if day is not None:
                    while stack and stack[-1][0] is not None and stack[-1][0] < day:
                        stack.pop()
                asked_rows.append(i)
                won.append(stack[-1][1] if stack and day is not None and who is not None else None)
            t = b.take(pa.array(asked_rows, pa.int64()))
            types = [b.schema.field(n).type for n in named]
            yield pa.RecordBatch.from_arrays(
                [*[t.column(c) for c in kept],
                 *[pa.array([None if w is None else w[k] for w in won], ty) for k, ty in enumerate(types)]], [*kept, *values])

    out = T.StructType([*headers.schema.fields, *[T.StructField(v, versions.schema[v].dataType) for v in values]])
    return both.mapInArrow(sweep, out)
