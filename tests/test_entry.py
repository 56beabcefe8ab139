"""The driver's entry with and without the text operators."""

import importlib.util
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def run(code, folder):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


def test_the_rest_works_without_the_text_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    got = run("import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and set(e.oracle_sql()) <= set(q) and not any(n.startswith('op') or n == 'pipeline' for n in q)", copy)
    assert got.returncode == 0, got.stderr
    (copy / "fathomline" / "llm" / "__pycache__").mkdir(parents=True)  # what a deleted package may leave
    assert run("import __spark_entry__ as e; e.queries()", copy).returncode == 0


@pytest.mark.skipif(not ((ROOT / "fathomline/llm/queries.py").exists() and (ROOT / "corpus_pipeline.py").exists()), reason="without the text operators")
def test_a_missing_library_is_an_error():
    assert importlib.util.find_spec("xxhash")
    got = run("import sys; sys.modules['xxhash'] = None; import __spark_entry__", ROOT)
    assert got.returncode != 0 and "xxhash" in got.stderr
