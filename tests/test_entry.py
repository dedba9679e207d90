"""The driver's entry points."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(entry.__file__).resolve().parent


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) >= 50


def test_works_without_the_optional_part(tmp_path):
    shutil.copytree(ROOT / "taxograph", tmp_path / "taxograph", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rank_filter' in q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q), q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
