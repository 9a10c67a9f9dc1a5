"""The entry file without the training-data subpackage."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, tmp_path):
    return subprocess.run([sys.executable, "-c", "import sys; sys.path.insert(0, sys.argv[1]); " + code, ROOT],
                          cwd=tmp_path, timeout=120, capture_output=True, text=True)


def test_it_works_without_the_subpackage(tmp_path):
    done = run("sys.modules['ledgerloom.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
               "assert 'fact_sales' in e.queries() and 'pipeline' not in e.queries(); assert set(e.oracle_sql()) <= set(e.queries())", tmp_path)
    assert done.returncode == 0, done.stderr


def test_another_missing_module_is_not_hidden(tmp_path):
    """A library that an operator needs and that is not installed is an error, not fewer queries."""
    done = run("import types; m = types.ModuleType('corpus_pipeline'); "
               "import importlib.abc, importlib.machinery\n"
               "class Broken(importlib.abc.MetaPathFinder, importlib.abc.Loader):\n"
               "    def find_spec(self, name, path, target=None):\n"
               "        return importlib.machinery.ModuleSpec(name, self) if name == 'corpus_pipeline' else None\n"
               "    def create_module(self, spec): return None\n"
               "    def exec_module(self, module): raise ModuleNotFoundError('no xxhash', name='xxhash')\n"
               "sys.meta_path.insert(0, Broken())\n"
               "try:\n    import __spark_entry__\nexcept ModuleNotFoundError as e:\n    assert e.name == 'xxhash'\n"
               "else:\n    raise SystemExit(1)", tmp_path)
    assert done.returncode == 0, done.stderr
