"""The mart published as SQL views (CREATE OR REPLACE VIEW re-aimed)."""

from __future__ import annotations

from ledgerloom.plans.warehouse_run import warehouse
from tests.oracle_harness import duck

SF = "/root/testdata/sf0.001"


def test_mart_views_answer_sql(spark):
    names = warehouse(spark, SF).register_views("mart_")
    assert {"mart_fact_sales", "mart_dim_products", "mart_core_orders"} <= set(names)
    got = {r["category"]: float(r["s"]) for r in spark.sql(
        "select p.category, sum(f.sales) as s from mart_fact_sales f "
        "join mart_dim_products p on f.product_id = p.product_id group by p.category").collect()}
    from ledgerloom.plans.oracle import compose
    want = {c: float(s) for c, s in duck(SF).execute(compose(
        "select p.category, sum(f.sales) from x_fact f join x_dim_products p "
        "on f.product_id = p.product_id group by 1")).fetchall()}
    assert got == want
