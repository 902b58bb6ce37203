"""The entry and its other queries stand without the corpus operators."""

import os
import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).parent.parent


def test_entry_imports_without_the_corpus_operators(tmp_path):
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", "__pycache__", ".git", "tests")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(q) == set(e.oracle_sql()) and len(q) >= 46; print(len(q))"
    env = os.environ | {"PYTHONPATH": str(tmp_path / "repo")}
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_corpus_operators():
    for f in (ROOT / "songpulse").rglob("*.py"):
        assert "songpulse.llm" not in f.read_text() or "llm" in f.parts, f


def test_entry_stands_without_a_library_of_the_corpus_operators(tmp_path):
    """A missing library of the optional part is reported and costs only that part."""
    for name in ("ahocorasick", "xxhash"):
        (tmp_path / f"{name}.py").write_text("raise ImportError('no such library here')")
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 46 and 'enrich_tweets' in q; e.oracle_sql()"
    env = os.environ | {"PYTHONPATH": f"{tmp_path}:{ROOT}"}
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "no such library here" in done.stderr or not (ROOT / "songpulse" / "llm").exists()
