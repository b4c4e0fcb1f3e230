"""Sending this package to the executors, which may have no copy of it."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Let the Python workers of a session import this package and the pipeline beside it, once per application.

    The archive is made in the driver's own folder of the Spark context; Spark gives it to every executor, also to those that
    join or are replaced later.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = Path(context._temp_dir) / "tallywatch-package.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for path in [*sorted(Path(__file__).parent.rglob("*.py")), ROOT / "corpus_pipeline.py"]:
                if path.exists():
                    out.write(path, path.relative_to(ROOT))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark
