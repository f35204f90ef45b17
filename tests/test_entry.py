"""The registered queries, with and without the optional subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def test_daily_queries_need_neither_subpackage_nor_pipeline(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).exists():
            shutil.copy(REPO / name, tmp_path)
    for name in ("shelfledger", "checks"):
        shutil.copytree(REPO / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    run = subprocess.run([sys.executable, "-c", NAMES], cwd=tmp_path, capture_output=True, text=True, check=True)
    queries, oracles = (line.split() for line in run.stdout.splitlines())
    assert "daily_source_digest" in queries and "pipeline" not in queries
    assert not any(name.startswith("op") for name in queries) and set(queries) == set(oracles)
