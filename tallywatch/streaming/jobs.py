"""Streams over the prediction log and the alert actions.

Every job takes a streaming DataFrame and writes files, so it restarts from its checkpoint after a lost executor.
`foreachBatch` jobs write each batch into a folder of its own in overwrite mode: a replayed batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywatch.functions.text import input_hash
from tallywatch.operators.alerts import routed
from tallywatch.operators.usage import ANOMALY_CONFIDENCE


def start(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append to Parquet until the source is exhausted; the sink's log makes every file count once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by).trigger(availableNow=True).start(path)


def start_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(availableNow=True).start()


def event_time(df: DataFrame, column: str = "predicted_at") -> DataFrame:
    """The time column as TIMESTAMP, which watermarks need."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def log_rows(stream: DataFrame) -> DataFrame:
    """Log rows as they are stored: hash of the text if there is one, day for partitioning, no row without deployment."""
    rows = stream.filter(F.col("deployment_id").isNotNull()).withColumn("predicted_on", F.to_date("predicted_at"))
    return rows.withColumn("input_hash", input_hash(F.col("input_text"))) if "input_text" in stream.columns else rows


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once append of predictions to the day-partitioned log."""
    return start(log_rows(stream), path, checkpoint, ["predicted_on"])


def windowed_counters(
    stream: DataFrame, keys: Sequence[str] = ("endpoint",), width: str = "1 hour", slide: str | None = None,
    delay: str = "10 minutes",
) -> DataFrame:
    """Predictions, errors and mean latency and confidence per window; windows are emitted once the watermark closes them."""
    timed = event_time(stream).withWatermark("predicted_at", delay)
    return (
        timed.groupBy(F.window("predicted_at", width, slide or width).alias("w"), *keys)
        .agg(
            F.count("*").alias("predictions"),
            F.count_if("is_error").alias("errors"),
            F.avg("prediction_time").alias("avg_prediction_time"),
            F.avg("confidence_score").alias("avg_confidence"),
        )
        .select(F.col("w.start").alias("window_start"), *keys, "predictions", "errors", "avg_prediction_time", "avg_confidence")
    )


def drop_repeats(stream: DataFrame, key: str = "request_id", delay: str = "1 hour") -> DataFrame:
    """Drop rows whose key was seen within the watermark delay; the state is dropped with it."""
    return event_time(stream).withWatermark("predicted_at", delay).dropDuplicatesWithinWatermark([key])


def low_confidence_alerts(stream: DataFrame, deployments: DataFrame, threshold: float = ANOMALY_CONFIDENCE) -> DataFrame:
    """An alert for every low-confidence prediction of an active deployment.

    A stream-static join: the deployments are read again for every batch, so a change of status takes effect.
    """
    active = deployments.filter(F.col("status") == "ACTIVE").select(F.col("id").alias("deployment_id"), "deployment_name")
    low = stream.filter(F.col("confidence_score") < threshold)
    return low.join(active, "deployment_id").select(
        F.concat(F.lit("low-confidence-"), F.col("id").cast("string")).alias("id"),
        F.lit("PERFORMANCE").alias("alert_type"),
        F.lit("MEDIUM").alias("severity"),
        F.lit("ACTIVE").alias("status"),
        "deployment_id",
        F.concat(F.lit("Low Confidence: "), F.col("deployment_name")).alias("title"),
        F.lit("confidence_score").alias("metric_name"),
        F.col("confidence_score").alias("metric_value"),
        F.lit(float(threshold)).alias("threshold_value"),
        F.col("predicted_at").alias("triggered_at"),
    )


def route_alerts(alerts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Active alerts to two partitions of one table: `route=notify` for HIGH and CRITICAL, `route=log` for the others."""

    def write(batch: DataFrame, batch_id: int) -> None:
        routed(batch).write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch={batch_id}")

    return start_batches(alerts, write, checkpoint)
