"""The entry module without the training-data subpackage: it imports, and the other queries are there."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as e
q, sql = e.queries(), e.oracle_sql()
assert len(q) > 50 and set(sql) <= set(q), (len(q), set(sql) - set(q))
assert not [n for n in q if n == "pipeline" or n.startswith("op")]
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert e.entry(s).count() >= 0 and e.entry(s).columns == ["user_id", "day", "score", "event_id", "support"]
"""


def copied(tmp_path, *without):
    to = tmp_path / "tree"
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in without:
        shutil.rmtree(to / name) if (to / name).is_dir() else (to / name).unlink()
    return to


def run(tree):
    return subprocess.run([sys.executable, "-c", CODE], cwd=tree, capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": str(tree)})


def test_without_the_folders(tmp_path):
    got = run(copied(tmp_path, "seqloom/llm", "tests/llm"))
    assert got.returncode == 0, got.stderr[-2000:]


def test_without_the_folders_and_the_pipeline(tmp_path):
    got = run(copied(tmp_path, "seqloom/llm", "tests/llm", "corpus_pipeline.py"))
    assert got.returncode == 0, got.stderr[-2000:]
