"""Spark session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallywatch.shipping import ship

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # streaming state is kept on disk, so it may outgrow the executors' memory
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # P15 collects at most max_length ids per text; the hash path keeps that aggregation from sorting
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def build_session(app: str = "tallywatch", master: str | None = None, **conf: str) -> SparkSession:
    """Start a session; `conf` keys use `__` for dots (`spark__sql__shuffle__partitions="8"`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULT_CONF | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())
