"""Cutting lineage on storage that every executor shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _shared(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; where that is unset, a temporary one, for local masters only."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tallywatch-"))
    return context._jsc.sc().getCheckpointDir().get()


def folder(spark: SparkSession, purpose: str) -> str:
    """The path of a new folder for files that every executor shares."""
    return f"{_shared(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of `df` on storage that every executor shares."""
    _shared(df.sparkSession)
    return df.checkpoint()


def packed(df: DataFrame, rows_at_most: int, rows_a_part: int) -> DataFrame:
    """`df`, of at most `rows_at_most` rows, in as few partitions as hold `rows_a_part` each, but two for every core.

    Every partition written is a file with a checksum file beside it; on a local disk the executor also starts a process for each
    to set its permissions, unless it has Hadoop's native library.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, 1 + rows_at_most // rows_a_part))


def gathered(df: DataFrame, rows_a_part: int, rows_at_most: int | None = None) -> DataFrame:
    """A checkpoint of `df` in as few partitions as hold `rows_a_part` rows each, at most as many as it has.

    Each partition of what follows writes its own shuffle files, so many nearly empty ones cost more disk than their rows. Where
    `rows_at_most` is known, no more files are written than that many rows need.
    """
    made = cut(df if rows_at_most is None else packed(df, rows_at_most, rows_a_part))
    return made.coalesce(1 + made.count() // rows_a_part)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to a new folder of the shared storage and read back; unlike `cut`, it may be joined with itself."""
    path = folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
