"""Run registered queries on Spark and their SQL on DuckDB, and compare.

Comparison: same column names, same type family per column, same row count,
and the same order-insensitive hash of the rows (columns sorted by name,
doubles rounded to 9 significant digits).

    python -m tests.oracle_harness [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import hashlib
import json
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_FAMILY = {"string": "str", "bigint": "int", "int": "int", "double": "float",
                "float": "float", "boolean": "bool", "smallint": "int", "tinyint": "int"}
DUCK_FAMILY = {"VARCHAR": "str", "BIGINT": "int", "INTEGER": "int", "DOUBLE": "float",
               "FLOAT": "float", "BOOLEAN": "bool", "HUGEINT": "int", "SMALLINT": "int",
               "TINYINT": "int", "UBIGINT": "int"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    return str(v)


def digest(cols: list[str], rows) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    sfam = [SPARK_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in sdf.schema.fields]
    t1 = time.time()
    out = {"query": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    dfam = [DUCK_FAMILY.get(str(d[1]), str(d[1])) for d in res.description]
    drows = res.fetchall()
    out["duck_rows"] = len(drows)
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={scols} duck={dcols}")
    else:
        sf = dict(zip(scols, sfam))
        df = dict(zip(dcols, dfam))
        bad = {c: (sf[c], df[c]) for c in scols if sf[c] != df[c]}
        if bad:
            problems.append(f"types {bad}")
        if len(srows) != len(drows):
            problems.append("rowcount")
        dperm = [dcols.index(c) for c in scols]
        drows2 = [tuple(r[i] for i in dperm) for r in drows]
        if digest(scols, srows) != digest(scols, drows2):
            problems.append("values")
            sset = {tuple(norm(x) for x in r) for r in srows}
            dset = {tuple(norm(x) for x in r) for r in drows2}
            out["only_spark"] = [list(r) for r in list(sset - dset)[:3]]
            out["only_duck"] = [list(r) for r in list(dset - sset)[:3]]
    out["status"] = "ok" if not problems else "MISMATCH: " + "; ".join(problems)
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from ledgerloom.session import build_session
    spark = build_session()
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(a.sf)
    names = a.names or list(qs)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, qs[n], sqls.get(n), a.sf)
        except Exception as e:  # report and go on
            r = {"query": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("ok", "no-oracle")
        print(json.dumps(r, default=str), flush=True)
    print(f"# {len(names) - bad}/{len(names)} ok", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
