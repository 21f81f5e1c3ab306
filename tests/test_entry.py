"""The entry works without the training-data package or a module that it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("module", ["zstandard", "public_tokenizers", "topicloom.llm", "corpus_pipeline"])
def test_other_queries_stay(module):
    code = f"""
import sys
sys.modules[{module!r}] = None
import __spark_entry__ as entry
from topicloom.plans.catalog import catalog
assert set(entry.queries()) == set(catalog()) == set(entry.oracle_sql()), "base queries alone"
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
