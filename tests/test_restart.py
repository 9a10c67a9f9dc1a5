"""A load step interrupted half-way resumes from its written tables."""

from __future__ import annotations

import os
import shutil
import uuid

from ledgerloom.plans import warehouse_run

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_interrupted_initial_load_resumes_with_the_same_keys(spark, monkeypatch):
    monkeypatch.setattr(warehouse_run, "NAMESPACE", f"ledgerloom-test-restart/{uuid.uuid4().hex}")
    first = warehouse_run.WarehouseRun(spark, SF)
    s = first.initial()
    want = {t: _rows(df) for t, df in s.tables().items()}
    root = first.root.replace("file:", "")
    # As if the job died while writing orders: orders has no success marker
    # and the lines (written after it) do not exist yet.
    os.remove(f"{root}/initial/orders/_SUCCESS")
    shutil.rmtree(f"{root}/initial/order_details")
    again = warehouse_run.WarehouseRun(spark, SF)       # a new driver, same folders
    got = {t: _rows(df) for t, df in again.initial().tables().items()}
    assert got == want
    shutil.rmtree(os.path.dirname(root))
