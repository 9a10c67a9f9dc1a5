"""Load audit rows, built as one-row aggregate frames (no driver round trips).

Counters follow the stated intent of the load script: inserted = order headers
inserted, updated = SCD1 updates + SCD2 closes, skipped = stage rows − inserted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import AUDIT


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def audit_row(load_id: int, load_type: str, source: str, processed: DataFrame,
              inserted: DataFrame | None = None, updated: DataFrame | None = None,
              skipped: DataFrame | None = None) -> DataFrame:
    """One audit row; each counter is a one-row, one-column frame (or 0)."""
    out = processed.select(F.col(processed.columns[0]).cast("long").alias("rows_processed"))
    for name, frame in (("rows_inserted", inserted), ("rows_updated", updated),
                        ("rows_skipped", skipped)):
        if frame is None:
            out = out.withColumn(name, F.lit(0).cast("long"))
        else:
            out = out.crossJoin(frame.select(F.col(frame.columns[0]).cast("long").alias(name)))
    return out.select(F.lit(load_id).cast("long").alias("load_id"),
                      F.lit(load_type).alias("load_type"), F.lit(source).alias("source_table"),
                      "rows_processed", F.lit("COMPLETED").alias("status"),
                      "rows_inserted", "rows_updated", "rows_skipped").select(*AUDIT)


def audit_started(spark: SparkSession, load_id: int, load_type: str, source: str) -> DataFrame:
    """The row that opens a load: no counts yet."""
    zero = [F.lit(0).cast("long").alias(c) for c in ("rows_processed", "rows_inserted", "rows_updated",
                                                     "rows_skipped")]
    return (spark.range(1).select(F.lit(load_id).cast("long").alias("load_id"),
                                  F.lit(load_type).alias("load_type"), F.lit(source).alias("source_table"),
                                  F.lit("STARTED").alias("status"), *zero).select(*AUDIT))


def audit_state(log: DataFrame) -> DataFrame:
    """One row a load: the finishing row where there is one, else the opening row."""
    rest = [c for c in AUDIT if c not in ("load_id", "status")]
    row = F.struct(F.when(F.col("status") == "STARTED", 0).otherwise(1).alias("_done"), "status", *rest)
    last = log.groupBy("load_id").agg(F.max(row).alias("_r"))
    return last.select("load_id", "_r.status", *[f"_r.{c}" for c in rest]).select(*AUDIT)


def audit_counted(spark: SparkSession, load_id: int, load_type: str, source: str, processed: int,
                  inserted: int = 0, updated: int = 0, skipped: int = 0) -> DataFrame:
    """The row that closes a load, from the counts that its writes took."""
    counts = {"rows_processed": processed, "rows_inserted": inserted, "rows_updated": updated, "rows_skipped": skipped}
    return spark.range(1).select(
        F.lit(load_id).cast("long").alias("load_id"), F.lit(load_type).alias("load_type"),
        F.lit(source).alias("source_table"), F.lit("COMPLETED").alias("status"),
        *[F.lit(n).cast("long").alias(c) for c, n in counts.items()]).select(*AUDIT)


def audit_incremental(spark: SparkSession, load_id: int, source: str, staged: int, counts: dict[str, int]) -> DataFrame:
    """The closing row of an incremental load: order headers inserted, customers overwritten and
    versions closed, stage rows that added no header."""
    n = counts["orders"]
    return audit_counted(spark, load_id, "SECONDARY", source, n, inserted=n,
                         updated=counts["scd1"] + counts["closed"], skipped=staged - n)


def refuse_second_initial(log: DataFrame | None) -> None:
    """An initial load is only done on an empty warehouse: a second one would load every line twice."""
    if log is not None and not log.where((F.col("load_type") == "INITIAL") & (F.col("status") == "COMPLETED")).isEmpty():
        raise ValueError("the initial load is already recorded as completed")


def next_load_id(log: DataFrame | None) -> int:
    """The id after the largest of the kept log; 1 where there is none."""
    return 1 if log is None else log.agg(F.coalesce(F.max("load_id"), F.lit(0)) + 1).first()[0]


def audit_correction(deleted_details: DataFrame, deleted_orders: DataFrame,
                     load_id: int = 3) -> DataFrame:
    n = _count(deleted_details, "d").crossJoin(_count(deleted_orders, "o"))
    return audit_row(load_id, "DATA_CORRECTION", "period_cleanup",
                     n.select((F.col("d") + F.col("o")).alias("n")))


def evolve_audit_columns(audit: DataFrame) -> DataFrame:
    """ALTER TABLE … ADD COLUMN … DEFAULT 0: add missing counters with 0 and
    fill NULL counters with their default."""
    for c in ("rows_inserted", "rows_updated", "rows_skipped"):
        if c not in audit.columns:
            audit = audit.withColumn(c, F.lit(0).cast("long"))
        else:
            audit = audit.withColumn(c, F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")))
    return audit


def with_times(audit: DataFrame, ended: bool = True) -> DataFrame:
    """Start/end timestamps for an audit row that is persisted as a log
    (left out of compared results: they are not deterministic). An opening row
    has no end yet."""
    now = F.current_timestamp()
    return audit.withColumn("start_time", now).withColumn("end_time", now if ended else F.lit(None).cast("timestamp"))


def load_times(log: DataFrame) -> DataFrame:
    """``load_id, load_type, start_time, end_time``: from the opening row to the closing one."""
    return log.groupBy("load_id", "load_type").agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))


def started_within(interval: str) -> Column:
    """Rows of a log that began within an interval before now."""
    return F.col("start_time") >= F.current_timestamp() - F.expr(f"interval {interval}")
