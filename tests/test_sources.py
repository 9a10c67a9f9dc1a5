"""File sources: Latin-1 CSV with the source header, CSV sink round trip."""

from __future__ import annotations

import glob
import uuid

from ledgerloom.schemas import DELTA_ORDERS, RAW_COLUMNS
from ledgerloom.session import ensure_checkpoint_dir
from ledgerloom.sources import files
from tests.edge_frames import stage


def _scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerloom-test-files/{uuid.uuid4().hex}"


def test_latin1_source_csv_round_trip(spark):
    rows = stage(spark, [dict(row_key="1", customer_name="Zoë Ångström", city="Málaga"),
                         dict(row_key="2", customer_name="Łukasz", segment=None)])
    path = _scratch(spark)
    src = rows.select(*RAW_COLUMNS).filter("row_key = '1'")
    files.write_source_csv(src, path)
    raw_bytes = b"".join(open(f, "rb").read() for f in glob.glob(path.replace("file:", "") + "/*.csv"))
    assert "Zoë Ångström".encode("latin-1") in raw_bytes          # written as Latin-1
    assert b"Customer Name" in raw_bytes                          # with the source header
    back = files.read_source_csv(spark, path).collect()
    assert [(r["customer_name"], r["city"]) for r in back] == [("Zoë Ångström", "Málaga")]


def test_csv_sink_keeps_null_and_empty_apart(spark):
    df = stage(spark, [dict(row_key="1", segment=None, valid_to="", postal_code=None)])
    path = _scratch(spark)
    files.write_csv(df, path)
    (r,) = files.read_csv(spark, path, DELTA_ORDERS).collect()
    assert r["segment"] is None and r["valid_to"] == "" and r["postal_code"] is None
