"""The package reaches workers that start in another folder and have no path to it."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

CODE = """
import importlib.util, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
queries = entry.queries()
for name in sys.argv[3:]:
    if name in queries:
        assert queries[name](spark, sys.argv[2]).count() > 0, name
print("all ran")
"""


@pytest.mark.parametrize("names", [["P15_J7_encoded_texts", "G14_external_model_scores", "op5_mixing", "op7_quality_rules"]])
def test_queries_run_from_another_folder(small, tmp_path, names):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    entry = Path(__file__).parents[1] / "__spark_entry__.py"
    done = subprocess.run([sys.executable, "-c", CODE, str(entry), small, *names], cwd=tmp_path, env=environment, capture_output=True, text=True)
    assert "all ran" in done.stdout, done.stderr[-2000:]
