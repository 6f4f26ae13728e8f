"""The entry module imports with and without the optional parts."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; from rollbook.bindings.checks import CHECKS; print(len(e.queries()) - len(CHECKS), len(e.oracle_sql()) - len(CHECKS))"


def _copied(folder, without: list[str]) -> str:
    skip = shutil.ignore_patterns(".git", "__pycache__", "tests", *without)
    shutil.copytree(ROOT, folder / "repo", ignore=skip)
    return str(folder / "repo")


def _counts(folder: str, code: str = COUNT) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("without", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_register_queries_stand_alone(tmp_path, without):
    done = _counts(_copied(tmp_path, without))
    assert done.stdout.split() == ["0", "0"], done.stderr


def test_other_missing_imports_are_errors(tmp_path):
    folder = _copied(tmp_path, ["llm"])
    with open(f"{folder}/corpus_pipeline.py", "w") as file:
        file.write("import no_such_module_at_all\n")
    assert "no_such_module_at_all" in _counts(folder).stderr
