"""Registered queries: name → (Spark callable, oracle SQL).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the given tables (through the stage and warehouse snapshots Spark derives from
them). Results pass through :func:`surface` so their types compare cleanly with
the DuckDB oracle: dates become ISO text, decimals double, small ints bigint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import keys
from ledgerloom.plans.oracle import compose
from ledgerloom.session import scratch_folder

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def surface(df: DataFrame) -> DataFrame:
    """Engine-neutral output types: dates → ISO text, decimals → double, small ints → bigint."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str, sql: str | None = None):
    """Register a query under ``name`` with its oracle SQL (CTEs are added by name)."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Key staging of each call goes to a folder of its own: an earlier
            # result of the query, or another job, may still read its files.
            # ``session.remove_scratch`` deletes old ones.
            base = f"{scratch_folder(spark, 'query-keys')}/{name}"
            with keys.staging_under(base):
                return surface(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = compose(sql)
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    """Import every query module once (registration happens on import)."""
    from ledgerloom.plans import (  # noqa: F401
        queries_core, queries_objects, queries_quality, queries_reports, queries_stage, queries_streaming,
        queries_time)
