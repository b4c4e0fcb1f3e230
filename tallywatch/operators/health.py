"""Status bands and the health rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.numeric import band

# Status names from best to worst, used by the rollup.
HEALTH_ORDER = ("healthy", "degraded", "unhealthy", "critical")

# Dashboard thresholds, colours from the lowest interval to the highest.
DASHBOARD_BANDS = {
    "confidence": ((0.6, 0.8), ("red", "yellow", "green")),
    "latency_s": ((0.1, 0.5), ("green", "yellow", "red")),
    "confidence_series": ((0.6, 0.7, 0.8), ("red", "orange", "yellow", "green")),
    "errors_per_min": ((1.0,), ("green", "red")),
    "active_requests": ((5.0, 10.0), ("green", "yellow", "red")),
}

STUCK_ALERT_LIMIT = 5


def confidence_status(value: Column) -> Column:
    return band(value, (0.6, 0.8), ("critical", "warning", "healthy"))


def low_confidence_status(rate: Column) -> Column:
    return band(rate, (0.1, 0.3), ("healthy", "warning", "critical"), inclusive_upper=True)


def latency_status(ms: Column) -> Column:
    return band(ms, (100.0, 500.0), ("healthy", "warning", "critical"), inclusive_upper=True)


def error_status(rate: Column) -> Column:
    return band(rate, (0.0, 0.01), ("healthy", "warning", "critical"), inclusive_upper=True)


def status_bands(df: DataFrame) -> DataFrame:
    """Add a status column for mean confidence, low-confidence rate, latency in ms and error rate."""
    return df.withColumns(
        {
            "confidence_status": confidence_status(F.col("avg_confidence")),
            "low_confidence_status": low_confidence_status(F.col("low_confidence_rate")),
            "latency_status": latency_status(F.col("latency_ms")),
            "error_status": error_status(F.col("error_rate")),
        }
    )


def dashboard_bands(df: DataFrame) -> DataFrame:
    """Add `<measure>_band` for every dashboard measure present."""
    return df.withColumns(
        {f"{name}_band": band(F.col(name), *rule) for name, rule in DASHBOARD_BANDS.items() if name in df.columns}
    )


def accuracy_band(accuracy: Column) -> Column:
    """Quality name of an accuracy: the top band starts above 0.95, the others at their lower edge."""
    lower = band(accuracy, (0.6, 0.7, 0.8, 0.9), ("Poor", "Fair", "Good", "Very Good", "Excellent"))
    return F.when(accuracy > 0.95, "Outstanding").otherwise(lower)


def alert_system_health(alerts: DataFrame, as_of: Column, hours: int = 24, limit: int = STUCK_ALERT_LIMIT) -> DataFrame:
    """One row: alerts still ACTIVE after `hours`, and whether there are too many of them."""
    stuck = F.count_if(
        (F.col("status") == "ACTIVE")
        & (F.col("triggered_at") < as_of - F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0.0)))
    )
    return alerts.agg(stuck.alias("stuck_alerts")).withColumn(
        "status", F.when(F.col("stuck_alerts") > limit, "degraded").otherwise("healthy")
    )


def overall_health(components: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The worst component status per key; `components` has a `status` column."""
    rank = F.array_position(F.array(*[F.lit(s) for s in HEALTH_ORDER]), F.col("status"))
    return components.groupBy(*(keys or [])).agg(
        F.max_by("status", rank).alias("overall_status"), F.count("*").alias("components")
    )
