"""The library without its optional part."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_the_corpus_operators(tmp_path):
    shutil.copytree(ROOT / "folioflow", tmp_path / "folioflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op') or n == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_the_other_tests_stand_alone(tmp_path):
    """Without both folders and the pipeline, the rest of the tests can be collected."""
    kept = shutil.ignore_patterns("llm", "__pycache__", ".git", ".pytest_cache", "corpus_pipeline.py")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=kept)
    subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests"], cwd=tmp_path / "repo", check=True, capture_output=True)


def test_nothing_else_imports_them():
    for path in (ROOT / "folioflow").rglob("*.py"):
        if "llm" not in path.parts:
            assert "folioflow.llm" not in path.read_text()
