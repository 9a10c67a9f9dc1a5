"""Registered query for the streaming form of the incremental load."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import upkeep
from ledgerloom.plans.queries_core import DET, ORD
from ledgerloom.plans.registry import register
from ledgerloom.plans.warehouse_run import warehouse as W
from ledgerloom.session import scratch_folder
from ledgerloom.streaming.incremental import SnapshotLog, run_incremental


def _run(spark, sf, mart: bool = False) -> dict:
    """Run the stream over the stage folder; the manifest of the last epoch."""
    w = W(spark, sf)
    seed = {**w.parts("cleanup"), "buckets": w.buckets, "audit": [f"{w.root}/audit/initial-completed"]}
    # Folders of this call alone: two jobs on one input must not share a stream's checkpoint.
    own = scratch_folder(spark, "stream")
    if mart:
        seed[upkeep.FACT] = upkeep.write_fact(SnapshotLog(spark, own).store(w.buckets), "seed", seed)
    return run_incremental(spark, f"{w.root}/stage/delta_orders", w.delta_orders().schema, seed, own, f"{own}/_checkpoint")


@register("streaming_incremental_load", f"select {ORD} from x_o2")
def streaming_incremental_load(spark, sf):
    """§2.13: the stage folder read with readStream; each micro-batch applied by
    foreachBatch with the batch load's functions. Returns the order headers
    after every available file is processed (same as the batch load)."""
    return upkeep.read(spark, "orders", _run(spark, sf)["orders"])


@register("streaming_order_details", f"select {DET} from x_d2")
def streaming_order_details(spark, sf):
    """§2.13: order lines after the stream, merged parts included."""
    return upkeep.read(spark, "order_details", _run(spark, sf)["order_details"])


@register("streaming_mart_snapshot", """
select cast(year(order_date) as bigint) as order_year, cast(count(*) as bigint) as fact_rows,
       cast(sum(sales) as double) as total_sales, cast(count(sales_region) as bigint) as placed
from x_fact group by 1""")
def streaming_mart_snapshot(spark, sf):
    """The mart's fact as the stream keeps it, each epoch making only its years anew."""
    fact = upkeep.read_fact(spark, _run(spark, sf, mart=True)[upkeep.FACT])
    return fact.groupBy(F.year("order_date").alias("order_year")).agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("sales").alias("total_sales"), F.count("sales_region").alias("placed"))
