"""Dense surrogate keys (SERIAL) assigned in a distributed way.

A global ``row_number() over (order by …)`` would send every row to one task.
Instead: range-partition by the ordering, sort inside each partition, count
rows per partition (one small row per partition), turn the counts into
prefix offsets, and add each row's position inside its partition.

Counting and numbering must see the very same partition contents. Range
bounds are sampled from the input (with a seed that depends on the RDD id),
so two evaluations of the range exchange can draw different bounds. The
tagged frame — partition id and in-partition position as plain columns — is
therefore written once as Parquet to the cluster's checkpoint folder and both
branches read that copy: the counts read one narrow column, the numbering
reads the rows, and a lost executor re-reads files instead of re-sampling.
The offsets frame has at most one row per partition, a proven bound for its
broadcast.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import ensure_checkpoint_dir

# How folders that the next step reads back are written: packed, sorted ids and texts as differences.
KEPT = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}

# Staging folders written so far, with the scope that wrote them. A caller
# that has materialised the keyed result (a snapshot writer) opens a scope and
# deletes only its own folders afterwards; other callers' folders are kept.
_OWNER: ContextVar[str | None] = ContextVar("ledgerloom_staging_owner", default=None)
_STAGED: list[tuple[str | None, str]] = []


# Where staging folders go: a fixed base with numbered folders (a repeated run
# of the same code reuses its folders instead of adding new ones), or, when
# unset, a fresh folder under the checkpoint folder.
_PLACE: ContextVar[tuple[str, itertools.count] | None] = ContextVar(
    "ledgerloom_staging_place", default=None)


@contextmanager
def staging_scope():
    """Tag staging folders created in this context (and in threads started
    with a copy of it) with a fresh owner id, yielded to the caller. They go
    to fresh folders; the owner deletes them once its results are written."""
    token = _OWNER.set(uuid.uuid4().hex)
    place = _PLACE.set(None)
    try:
        yield _OWNER.get()
    finally:
        _PLACE.reset(place)
        _OWNER.reset(token)


@contextmanager
def staging_under(base: str):
    """Staging folders created in this context go to ``base/0``, ``base/1``, …"""
    token = _PLACE.set((base.rstrip("/"), itertools.count()))
    try:
        yield
    finally:
        _PLACE.reset(token)


def _staging_path(spark) -> str:
    place = _PLACE.get()
    if place is None:
        return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerloom-keys/{uuid.uuid4().hex}"
    base, counter = place
    return f"{base}/{next(counter)}"


def staged_by(owner: str) -> list[str]:
    return [p for o, p in _STAGED if o == owner]


def assign_dense_keys(df: DataFrame, key: str, order: Sequence[Column],
                      start: DataFrame | int = 0, partitions: int | None = None) -> DataFrame:
    """Add ``key`` = start + 1, 2, … following ``order`` (which must be total for
    the numbering to be unique up to identical rows).

    ``start`` is a number or a one-row, one-column frame (e.g. the current max id).
    """
    spark = df.sparkSession
    path = _staging_path(spark)
    pid = F.spark_partition_id()
    # Without an explicit count the range exchange starts from the session's
    # shuffle partitions and AQE may coalesce neighbouring ranges; coalesced
    # partitions stay in range order, so partition ids still follow the order.
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    (ranged.sortWithinPartitions(*order)
     .withColumn("_pid", pid)
     .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
     .write.mode("overwrite").options(**KEPT).parquet(path))
    _STAGED.append((_OWNER.get(), path))
    tagged = spark.read.parquet(path)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    if isinstance(start, DataFrame):
        base = start.select(F.coalesce(F.col(start.columns[0]).cast("long"), F.lit(0)).alias("_base"))
        offsets = offsets.crossJoin(base)
    else:
        offsets = offsets.withColumn("_base", F.lit(int(start)).cast("long"))
    numbered = tagged.join(F.broadcast(offsets), "_pid")
    out = numbered.withColumn(key, F.col("_base") + F.col("_off") + F.col("_pos") + 1)
    return out.select(key, *[c for c in df.columns if c != key])
