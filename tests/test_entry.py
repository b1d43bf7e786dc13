"""The registered queries without their optional part."""

from __future__ import annotations

import subprocess
import sys

import pytest

from conftest import ROOT
from crowdtide.workload import catalog

HIDE = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any(n.startswith("op1_") for n in entry.queries()))
"""


@pytest.mark.parametrize("name", ["public_tokenizers", "crowdtide.llm", "corpus_pipeline"])
def test_core_queries_stay_when_an_optional_part_is_missing(name):
    done = subprocess.run([sys.executable, "-c", HIDE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(catalog.QUERIES)), str(len(catalog.QUERIES)), "False"]
