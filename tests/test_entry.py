"""The driver's entry keeps the core queries where the training-data subpackage or a library of its can't be imported."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT

BLOCK = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert "postcode_pages" in q and len(q) > 50 and set(o) <= set(q), len(q)
assert not any(k.startswith("op") and k[2:3].isdigit() for k in q) and "pipeline" not in q
"""


@pytest.mark.parametrize("name", ["pagesift.llm", "zstandard"])
def test_core_queries_stay(name):
    run = subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True,
                         env=os.environ | {"PYTHONPATH": ROOT})
    assert run.returncode == 0, run.stderr
    assert "left out" in run.stderr
