"""The entry works without the extra operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

ASK = "import __spark_entry__ as e; print(sorted(n for n in e.queries() if not n.startswith('q_')), len(e.queries()), len(e.oracle_sql()))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_extra_folders(tmp_path, pipeline):
    """A copy without both folders, with and without the pipeline file beside it, has the other queries."""
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "noticeworks"), copy / "noticeworks", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy)
    if pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), copy)
    out = subprocess.run([sys.executable, "-c", ASK], cwd=copy, capture_output=True, text=True, timeout=120, check=True).stdout
    extra, n, n_sql = out.rsplit(" ", 2)
    assert extra == "[]" and int(n) == int(n_sql) > 90
