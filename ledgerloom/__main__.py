"""Command line: run the warehouse steps in order, or show a registered query.

    python -m ledgerloom load  --sf /root/testdata/sf0.01
    python -m ledgerloom query category_matrix --sf /root/testdata/sf0.01 [--rows 20]
    python -m ledgerloom explain fact_sales --sf /root/testdata/sf0.01
    python -m ledgerloom list
"""

from __future__ import annotations

import argparse
import json
import os
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    load = sub.add_parser("load", help="stage → initial → clean-up → incremental → correction → mart")
    load.add_argument("--sf", required=True)
    q = sub.add_parser("query", help="show one registered query")
    q.add_argument("name")
    q.add_argument("--sf", required=True)
    q.add_argument("--rows", type=int, default=20)
    ex = sub.add_parser("explain", help="formatted physical plan of one registered query")
    ex.add_argument("name")
    ex.add_argument("--sf", required=True)
    sub.add_parser("list", help="list the registered queries")
    a = ap.parse_args(argv)

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from ledgerloom.plans import registry
    registry.load_all()
    if a.cmd == "list":
        for name, fn in registry.QUERIES.items():
            print(f"{name:32s} {(fn.__doc__ or '').strip().splitlines()[0]}")
        return 0

    from ledgerloom.plans.warehouse_run import warehouse
    from ledgerloom.session import build_session
    spark = build_session()
    if a.cmd == "load":
        w = warehouse(spark, a.sf)
        w.raw_orders()
        w.delta_orders()
        w.mart()
        print(json.dumps({"root": w.root,
                          "tables": {step: w.parts(step) for step in
                                     ("initial", "cleanup", "secondary", "correction")}},
                         indent=2))
    elif a.cmd == "explain":
        registry.QUERIES[a.name](spark, a.sf).explain("formatted")
    else:
        registry.QUERIES[a.name](spark, a.sf).show(a.rows, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
