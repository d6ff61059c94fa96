"""The entry module works without the training-data subpackage and its pipeline."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as e
names = set(e.queries())
assert names and not any(n.startswith("op") or n == "pipeline" for n in names)
assert set(e.oracle_sql()) <= names
"""


def run(folder, code):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)}, timeout=120, capture_output=True, text=True)


def test_entry_without_llm(tmp_path):
    shutil.copytree(ROOT / "casequarry", tmp_path / "casequarry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    done = run(tmp_path, CODE)
    assert done.returncode == 0, done.stderr


def test_entry_shows_errors_within_llm(tmp_path):
    shutil.copytree(ROOT / "casequarry", tmp_path / "casequarry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "casequarry" / "llm").mkdir()
    (tmp_path / "casequarry" / "llm" / "__init__.py").touch()
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module_anywhere")
    done = run(tmp_path, CODE)
    assert done.returncode != 0 and "no_such_module_anywhere" in done.stderr


def test_nothing_else_imports_llm():
    for path in (ROOT / "casequarry").rglob("*.py"):
        if "llm" not in path.parts:
            assert "casequarry.llm" not in path.read_text(), path
