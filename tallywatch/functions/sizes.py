"""The shared scratch folder, and how finely hot keys are split."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_folder() -> str:
    """One folder per process for local masters without a shared one; removed when the process ends."""
    path = tempfile.mkdtemp(prefix="tallywatch-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared `spark.checkpoint.dir`; a local one only for local masters."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a costly result that is read several times to the shared scratch folder and read it back."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces_of(spark: SparkSession) -> int:
    """Pieces that an ordered operation splits a key into: as many as a shuffle has partitions."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
