"""The entry file works when loaded by path from another folder, in a plain session."""

import subprocess
import sys
from pathlib import Path

import pytest

ENTRY = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
DATA = "/root/testdata/sf0.001"

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry", {str(ENTRY)!r})
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
queries = module.queries()
sizes = [len(queries[n](spark, {DATA!r}).collect()) for n in ("predict", "shap_contributions")]
print("sizes", sizes)
"""


@pytest.mark.skipif(not Path(DATA).is_dir(), reason="test tables are not here")
def test_python_workers_find_the_package(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "sizes [6000, 6000]" in done.stdout, done.stderr[-2000:]
