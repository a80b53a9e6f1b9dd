"""The rest of the library without the training-data subpackage and its tests."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as e, pathlib
from pyspark.sql import SparkSession
names = set(e.queries())
assert "condition_summary" in names and not any(n.startswith("op") for n in names) and "pipeline" not in names and set(e.oracle_sql()) <= names, names
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", e.queries()["band_counts"](spark, FOLDER).count())
"""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
@pytest.mark.parametrize("with_pipeline", [True, False])
def test_without_the_subpackage(tmp_path, with_pipeline):
    shutil.copytree(ROOT / "kerbstone", tmp_path / "kerbstone", ignore=shutil.ignore_patterns("__pycache__", "llm"))
    for name in ["__spark_entry__.py", *(["corpus_pipeline.py"] if with_pipeline and (ROOT / "corpus_pipeline.py").exists() else [])]:
        shutil.copy(ROOT / name, tmp_path / name)
    code = "FOLDER = '/root/testdata/sf0.001'" + CODE
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=300)
    assert "ROWS" in run.stdout, run.stderr[-2000:]
