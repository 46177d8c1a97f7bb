"""The library without its folders for training text."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def listed(folder):
    """Names of the registered queries and statements of the copy in ``folder``, and what
    pytest would run there."""
    code = "import __spark_entry__ as e; print(len(e.queries()), *sorted(e.queries())); print(*e.oracle_sql())"
    run = lambda *a: subprocess.run(
        [sys.executable, "-B", *a], cwd=folder, capture_output=True, text=True, timeout=300
    )
    names = run("-c", code)
    assert names.returncode == 0, names.stderr
    found = run("-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider")
    assert found.returncode == 0, found.stdout
    return names.stdout.split(), found.stdout


def copy(folder, *left_out):
    def skip(place, names):
        inside = os.path.relpath(place, ROOT)
        return {n for n in names if n in (".git", "__pycache__") or os.path.normpath(os.path.join(inside, n)) in left_out}

    shutil.copytree(ROOT, folder, ignore=skip)
    return folder


def test_imports_and_collects_without_the_folders(tmp_path):
    gone = ("tagloom/llm", "tests/llm", "corpus_pipeline.py")
    for left_out in (gone, gone[:2]):
        names, found = listed(copy(str(tmp_path / str(len(left_out))), *left_out))
        assert not [n for n in names if n.startswith("op") or n == "pipeline"]
        assert "agg_rare_tags" in names and "tests/test_thresholds.py" in found
