"""Finding out what has been written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException


def existing(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table under `path`, or nothing where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def finished(spark: SparkSession, path: str) -> bool:
    """Whether the job that writes `path` has ended well."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(folder) if f.isDirectory())
