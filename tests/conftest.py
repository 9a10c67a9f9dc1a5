from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import build_session
    # The checkpoint folder is the session's; build_session names a local one
    # only when none is configured.
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()
