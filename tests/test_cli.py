"""The command line lists every registered query."""

from __future__ import annotations

from ledgerloom.plans import registry
from ledgerloom.__main__ import main


def test_list_names_every_query(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    listed = {line.split()[0] for line in out.splitlines() if line.strip()}
    assert listed == set(registry.QUERIES)
