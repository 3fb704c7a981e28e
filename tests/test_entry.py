"""The contract holds without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def registered(folder):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(q.startswith('op') and q[2].isdigit() for q in e.queries()), 'pipeline' in e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


def test_entry_imports_without_the_corpus_operators(tmp_path):
    """Copies of the repository: without the llm folders, and without the pipeline too."""
    skip = shutil.ignore_patterns(".git", "__pycache__", "llm")
    for k, more in enumerate(([], ["corpus_pipeline.py"])):
        copy = tmp_path / str(k)
        shutil.copytree(ROOT, copy, ignore=lambda d, names, more=more: {*skip(d, names), *[n for n in names if n in more]})
        n, n_sql, n_ops, pipeline = registered(copy)
        assert int(n) >= 120 and int(n_sql) == int(n) and n_ops == "0" and pipeline == "False"
