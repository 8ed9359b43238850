"""The entry works in a copy that has no corpus operators, with or without the pipeline file."""

import os
import shutil
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as E; q = E.queries(); print(len(q), set(E.oracle_sql()) == set(q), sorted(q)[0])"


def copy_without(*left_out):
    root = tempfile.mkdtemp(prefix="daypulse-test-copy-")
    hide = shutil.ignore_patterns(*left_out, "__pycache__")
    shutil.copytree(os.path.join(ROOT, "daypulse"), os.path.join(root, "daypulse"), ignore=hide)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), root)
    return root


def test_entry_without_corpus_operators():
    from daypulse.plans.queries import QUERIES

    for left_out in (["llm"], ["llm", "corpus_pipeline.py"]):
        got = subprocess.run([sys.executable, "-c", SAY], cwd=copy_without(*left_out), capture_output=True, text=True)
        assert got.returncode == 0, got.stderr
        assert got.stdout.split()[:2] == [str(len(QUERIES)), "True"]
