"""Alerts: summaries, drift alerts, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.operators.filters import since
from tallywatch.schemas import DRIFT_ALERT_TYPES, NOTIFY_SEVERITY

HIGH_DRIFT_SCORE = 0.3
DRIFT_THRESHOLD = 0.1

# Alert type of each kind of drift.
DRIFT_TO_ALERT = {"data": "DATA_DRIFT", "concept": "CONCEPT_DRIFT", "model": "MODEL_DRIFT"}


def alert_summary(alerts: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Counts by status, by severity, by type and in total, from one pass.

    `dimension` names the marginal, so a NULL value is never mistaken for a total. The total row carries the mean hours
    to resolution and the alerts per day.
    """
    recent = since(alerts, "triggered_at", as_of, days=days)
    # seconds as whole numbers: differences of zone-less timestamps in one zone
    hours = (F.unix_seconds(F.col("resolved_at").cast("timestamp"))
             - F.unix_seconds(F.col("triggered_at").cast("timestamp"))) / 3600
    resolved = (F.col("status") == "RESOLVED") & F.col("resolved_at").isNotNull()
    sets = [[F.col("status")], [F.col("severity")], [F.col("alert_type")], []]
    counted = recent.groupingSets(sets, "status", "severity", "alert_type").agg(
        F.count("*").alias("n"),
        F.avg(F.when(resolved, hours)).alias("hours"),
        F.grouping_id().alias("gid"),
    )
    # grouping_id bits (status, severity, alert_type): 1 means rolled up
    total = F.col("gid") == 7
    return counted.select(
        F.when(total, "total")
        .when(F.col("gid") == 3, "status")
        .when(F.col("gid") == 5, "severity")
        .otherwise("alert_type")
        .alias("dimension"),
        F.coalesce("status", "severity", "alert_type").alias("value"),
        F.col("n"),
        F.when(total, F.col("hours")).alias("avg_resolution_time_hours"),
        F.when(total, F.col("n") / F.lit(float(days))).alias("alerts_per_day"),
    )


def drift_alert_summary(alerts: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Drift alerts by type and severity with both marginals and the total; `level` is 0 for pairs, 3 for the total."""
    drift = since(alerts, "triggered_at", as_of, days=days).filter(F.col("alert_type").isin(*DRIFT_ALERT_TYPES))
    return drift.cube("alert_type", "severity").agg(
        F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("level")
    )


def active_alert_gauge(alerts: DataFrame) -> DataFrame:
    """Active alerts per severity and type."""
    return alerts.filter(F.col("status") == "ACTIVE").groupBy("severity", "alert_type").agg(F.count("*").alias("n"))


def alert_totals(alerts: DataFrame) -> DataFrame:
    """All, active and critical alerts."""
    return alerts.agg(
        F.count("*").alias("total_alerts"),
        F.count_if(F.col("status") == "ACTIVE").alias("active_alerts"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_alerts"),
    )


def alerts_with_deployments(alerts: DataFrame, deployments: DataFrame) -> DataFrame:
    """Every alert with the deployment it is about, if it names a known one."""
    known = deployments.select(F.col("id").alias("deployment_id"), "deployment_name",
                               F.col("status").alias("deployment_status"))
    return alerts.join(known, "deployment_id", "left")


def drift_severity(score: Column) -> Column:
    return F.when(score > HIGH_DRIFT_SCORE, "HIGH").otherwise("MEDIUM")


def alert_title(alert_type: Column) -> Column:
    return F.concat(F.initcap(F.replace(alert_type, F.lit("_"), F.lit(" "))), F.lit(" Detected"))


def drift_description(score: Column) -> Column:
    return F.format_string("Drift detected with score %.3f", score)


def drift_alerts(results: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Alerts for the detected drifts among results (deployment_id, drift_type, is_drift_detected, drift_score, ...)."""
    pairs = [F.lit(x) for kind in DRIFT_TO_ALERT.items() for x in kind]
    alert_type = F.element_at(F.create_map(*pairs), F.col("drift_type"))
    return results.filter("is_drift_detected").select(
        alert_type.alias("alert_type"),
        drift_severity(F.col("drift_score")).alias("severity"),
        "deployment_id",
        alert_title(alert_type).alias("title"),
        drift_description(F.col("drift_score")).alias("description"),
        F.concat(F.col("drift_type"), F.lit("_drift_score")).alias("metric_name"),
        F.col("drift_score").alias("metric_value"),
        F.lit(float(threshold)).alias("threshold_value"),
    )


def routed(alerts: DataFrame) -> DataFrame:
    """Where each active alert goes: HIGH and CRITICAL ones to `notify`, the others to `log`."""
    urgent = F.col("severity").isin(*NOTIFY_SEVERITY)
    return alerts.filter(F.col("status") == "ACTIVE").withColumn("route", F.when(urgent, "notify").otherwise("log"))


def health_alerts(health: DataFrame) -> DataFrame:
    """A SYSTEM_HEALTH alert for every unhealthy or critical overall status."""
    status = F.col("overall_status")
    return health.filter(status.isin("critical", "unhealthy")).select(
        F.lit("SYSTEM_HEALTH").alias("alert_type"),
        F.when(status == "critical", "CRITICAL").otherwise("HIGH").alias("severity"),
        F.concat(F.lit("System Health: "), F.upper(status)).alias("title"),
        F.concat(F.lit("System health status: "), status).alias("description"),
    )
