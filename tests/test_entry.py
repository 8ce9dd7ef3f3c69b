"""The driver contract with and without the optional folders."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.modules.update(dict.fromkeys({gone!r}))
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), "pipeline" in e.queries())
"""


@pytest.mark.parametrize("gone", [["haulbook.llm", "corpus_pipeline"], ["corpus_pipeline"], ["haulbook.llm"]])
def test_entry_without_the_llm_folders(gone):
    run = subprocess.run([sys.executable, "-c", CODE.format(gone=gone)], cwd=ROOT, capture_output=True, text=True)
    assert run.stdout.split("\n")[-2] == "39 39 False", run.stderr


def test_entry_hides_no_other_missing_module():
    run = subprocess.run([sys.executable, "-c", CODE.format(gone=["oracle_checks"])], cwd=ROOT, capture_output=True)
    assert run.returncode
