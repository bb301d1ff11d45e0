"""Kernels run where the workers cannot find the library by themselves."""

import os
import shutil
import subprocess
import sys
import tempfile
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
SCRIPT = """
import importlib.util, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1] + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.driver.memory", "2g").getOrCreate()
)
for name in sys.argv[3:]:
    assert entry.queries()[name](spark, sys.argv[2]).count() > 0, name
print("ran all")
"""


def test_from_a_foreign_folder(small):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    names = ["kmeans_labels", "silhouette_euclidean", "ward_labels", "davies_bouldin"]
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(REPO), small, *names], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True, timeout=600
    )
    assert "ran all" in out.stdout, out.stderr[-2000:]


def test_entry_without_the_operators_on_texts():
    """The other queries stay registered when that subpackage is not there, with or without the pipeline's file."""
    copy = Path(tempfile.mkdtemp())
    shutil.copytree(REPO / "clickloom", copy / "clickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).exists():
            shutil.copy(REPO / name, copy)
    say = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", say], cwd=copy, capture_output=True, text=True, timeout=120)
    from clickloom.catalog import queries

    assert out.stdout.split() == [str(len(queries.registered())), "[]", "False"], out.stderr[-2000:]
