"""Statistics over the prediction log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.numeric import share, truthy
from tallywatch.operators.filters import since

LOW_CONFIDENCE = 0.6
ANOMALY_CONFIDENCE = 0.5


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def distribution(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per value inside the keys, NULL as a value of its own: columns keys, `value`, `n`."""
    return df.groupBy(*keys, F.col(value).alias("value")).agg(F.count("*").alias("n"))


def distribution_map(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The distribution as one map per key, for reports; one entry per distinct value."""
    named = distribution(df, keys, value).filter(F.col("value").isNotNull())
    entries = F.array_sort(F.collect_list(F.struct(F.col("value").cast("string"), "n")))
    return named.groupBy(*keys).agg(F.map_from_entries(entries).alias("distribution"))


def prediction_statistics(logs: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """Per deployment: totals, and confidence and time statistics over values that are neither NULL nor 0."""
    confidence, time = truthy(F.col("confidence_score")), truthy(F.col("prediction_time"))
    return (
        since(logs, "predicted_at", as_of, hours=hours)
        .groupBy("deployment_id")
        .agg(
            F.count("*").alias("total_predictions"),
            _or_zero(F.avg(confidence)).alias("avg_confidence"),
            _or_zero(F.min(confidence)).alias("min_confidence"),
            _or_zero(F.max(confidence)).alias("max_confidence"),
            _or_zero(F.avg(time)).alias("avg_prediction_time"),
            (F.count("*") / F.lit(float(hours))).alias("predictions_per_hour"),
        )
    )


def deployment_metrics(deployments: DataFrame, logs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Every deployment with its averages over all rows (NULL counts as 0); NULL metrics where nothing was logged."""
    used = (
        since(logs, "predicted_at", as_of, days=days)
        .groupBy("deployment_id")
        .agg(
            F.count("*").alias("total_predictions"),
            (F.sum(_or_zero(F.col("prediction_time"))) / F.count("*")).alias("avg_prediction_time_ms"),
            (F.sum(_or_zero(F.col("confidence_score"))) / F.count("*")).alias("avg_confidence_score"),
            (F.count("*") / F.lit(float(days))).alias("predictions_per_day"),
        )
    )
    known = deployments.select(F.col("id").alias("deployment_id"), "deployment_name", "status")
    return known.join(used, "deployment_id", "left")


def idle_deployments(deployments: DataFrame, logs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Deployments that logged nothing in the window."""
    seen = since(logs, "predicted_at", as_of, days=days).select("deployment_id").distinct()
    return deployments.join(seen, deployments.id == seen.deployment_id, "left_anti")


def logs_of_active(deployments: DataFrame, logs: DataFrame) -> DataFrame:
    """Log rows of deployments that are ACTIVE."""
    active = deployments.filter(F.col("status") == "ACTIVE").select(F.col("id").alias("deployment_id"))
    return logs.join(active, "deployment_id", "left_semi")


def daily_performance(logs: DataFrame, keys: Sequence[str] = ("deployment_id",)) -> DataFrame:
    """Per key and day: mean confidence, count and mean time."""
    return logs.groupBy(*keys, F.to_date("predicted_at").alias("prediction_date")).agg(
        F.avg("confidence_score").alias("avg_confidence"),
        F.count("*").alias("prediction_count"),
        F.avg("prediction_time").alias("avg_prediction_time"),
    )


def snapshot(logs: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """One row over the window: count, confidence mean and sample deviation, label counts, mean time."""
    recent = since(logs, "predicted_at", as_of, hours=hours)
    low = F.count_if(F.col("confidence_score") < LOW_CONFIDENCE)
    return recent.agg(
        F.count("*").alias("total_predictions"),
        F.avg("confidence_score").alias("avg_confidence"),
        F.stddev_samp("confidence_score").alias("confidence_stddev"),
        low.alias("low_confidence_count"),
        F.count_if(F.col("predicted_sentiment") == "POSITIVE").alias("positive_count"),
        F.count_if(F.col("predicted_sentiment") == "NEGATIVE").alias("negative_count"),
        F.avg("prediction_time").alias("avg_prediction_time_ms"),
        share(low, F.count("*")).alias("low_confidence_rate"),
    )


def hourly_volume(logs: DataFrame) -> DataFrame:
    """Predictions and mean confidence per hour."""
    return (
        logs.groupBy(F.window("predicted_at", "1 hour"))
        .agg(F.count("*").alias("predictions"), F.avg("confidence_score").alias("avg_confidence"))
        .select(F.col("window.start").alias("hour"), "predictions", "avg_confidence")
    )


def model_metrics(logs: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """Per deployment: the statistics report with the low-confidence count and the error rate."""
    extra = (
        since(logs, "predicted_at", as_of, hours=hours)
        .groupBy("deployment_id")
        .agg(
            F.count("*").alias("total_predictions"),
            _or_zero(F.avg(truthy(F.col("prediction_time")))).alias("avg_prediction_time_ms"),
            (F.count("*") / F.lit(float(hours))).alias("predictions_per_hour"),
            _or_zero(F.avg(truthy(F.col("confidence_score")))).alias("avg_confidence_score"),
            F.count_if(F.col("confidence_score") < LOW_CONFIDENCE).alias("low_confidence_predictions"),
            share(F.count_if("is_error"), F.count("*")).alias("error_rate"),
        )
    )
    return extra


def counter(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Total per label combination."""
    return df.groupBy(*labels).agg(F.count("*").alias("total"))


def sentiment_share(logs: DataFrame) -> DataFrame:
    """Share of each sentiment among all predictions."""
    counts = logs.groupBy("predicted_sentiment").agg(F.count("*").alias("n"))
    # the window sees one row per sentiment
    return counts.withColumn("share", share(F.col("n"), F.sum("n").over(Window.partitionBy())))


def label_entropy(logs: DataFrame, keys: Sequence[str] = ("deployment_id",)) -> DataFrame:
    """Entropy in bits of the sentiments inside each key."""
    counts = logs.groupBy(*keys, "predicted_sentiment").agg(F.count("*").cast("double").alias("n"))
    # sum n*log2(n) needs no second pass for the total: H = log2(N) - sum(n*log2 n)/N
    total = F.sum("n")
    return counts.groupBy(*keys).agg(
        (F.log2(total) - F.sum(F.col("n") * F.log2("n")) / total).alias("entropy"),
        total.cast("bigint").alias("predictions"),
    )


def confidence_summary(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean, least and greatest confidence of a scored set."""
    return scored.groupBy(*keys).agg(
        F.avg("confidence_score").alias("mean_confidence"),
        F.min("confidence_score").alias("min_confidence"),
        F.max("confidence_score").alias("max_confidence"),
    )


def deployment_gauges(deployments: DataFrame, logs: DataFrame) -> DataFrame:
    """Per active deployment: its stored response time (0 if NULL) and its mean logged confidence."""
    confidence = logs.groupBy("deployment_id").agg(F.avg("confidence_score").alias("avg_confidence"))
    active = deployments.filter(F.col("status") == "ACTIVE")
    return active.join(confidence, active.id == confidence.deployment_id, "left").select(
        F.col("id").alias("deployment_id"),
        _or_zero(F.col("avg_response_time")).alias("avg_response_time"),
        "avg_confidence",
    )


def feedback_joined(feedback: DataFrame, logs: DataFrame) -> DataFrame:
    """Feedback with the prediction it refers to; feedback on an unknown prediction is left out."""
    predictions = logs.select(
        F.col("id").alias("prediction_id"), "deployment_id", "model_version", "predicted_label", "confidence_score"
    )
    return feedback.join(predictions, "prediction_id")


def feedback_accuracy(
    feedback: DataFrame, logs: DataFrame, keys: Sequence[str] = ("deployment_id", "model_version")
) -> DataFrame:
    """Share of predictions marked correct and mean feedback score per deployment and model version."""
    return feedback_joined(feedback, logs).groupBy(*keys).agg(
        F.count("*").alias("feedback_count"),
        F.avg(F.col("is_correct").cast("int")).alias("accuracy"),
        F.avg("feedback_score").alias("avg_feedback_score"),
    )


def anomalies(logs: DataFrame, threshold: float = ANOMALY_CONFIDENCE) -> DataFrame:
    """Predictions below a confidence, strictly."""
    return logs.filter(F.col("confidence_score") < threshold)


def latest_gauge(samples: DataFrame, labels: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The last value of a gauge per label combination."""
    return samples.groupBy(*labels).agg(F.max_by(value, F.struct(*order)).alias("value"))
