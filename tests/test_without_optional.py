"""The entry with parts of the repository left out."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from auditlake.queries import QUERIES

REPO = Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def keys_of(repo: Path) -> list[set[str]]:
    told = subprocess.run([sys.executable, "-c", SHOW], cwd=repo, capture_output=True, text=True, timeout=120, check=True)
    return [set(line.split()) for line in told.stdout.splitlines()]


@pytest.mark.parametrize("pipeline", [False, True])
def test_entry_without_the_operators_for_training_data(tmp_path, pipeline):
    """An empty folder of the package may be left behind, and the pipeline's file."""
    copy = tmp_path / "copy"
    shutil.copytree(REPO / "auditlake", copy / "auditlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (copy / "auditlake" / "llm").mkdir()
    shutil.copy(REPO / "__spark_entry__.py", copy)
    if pipeline and (REPO / "corpus_pipeline.py").exists():
        shutil.copy(REPO / "corpus_pipeline.py", copy)
    queries, oracles = keys_of(copy)
    assert queries == QUERIES.keys() and oracles == QUERIES.keys()
