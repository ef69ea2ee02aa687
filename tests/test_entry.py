"""The entry point where folders of the training-data operators are missing."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left_out", [("quarterbell/llm",), ("quarterbell/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_the_entry_imports_without_them(tmp_path, left_out):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm" if "quarterbell/llm" in left_out else "", *left_out))
    shown = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(k.startswith('op') or k == 'pipeline' for k in e.queries()))"
    done = subprocess.run([sys.executable, "-c", shown], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)})
    assert done.returncode == 0, done.stderr
    every, oracles, training = map(int, done.stdout.split())
    assert every - training >= 39 and oracles >= 39
    assert (training == 0) == ("quarterbell/llm" in left_out)


def test_other_missing_modules_are_not_hidden(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "session.py"))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)})
    assert done.returncode != 0 and "quarterbell.session" in done.stderr
