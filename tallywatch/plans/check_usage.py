"""Checked queries over the prediction log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions.numeric import settle
from tallywatch.functions.text import input_hash, preview
from tallywatch.operators import filters, usage
from tallywatch.plans.registry import query, settled
from tallywatch.sources.canonical import Tables

AS_OF = "2024-01-31 00:00:00"
RECENT_DAY = f"predicted_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR"
RECENT_WEEK = f"predicted_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY"


def _settle(df, *columns, digits=6):
    return df.withColumns({c: settle(F.col(c), digits) for c in columns})


@query(
    "A1_prediction_statistics",
    "prediction_logs",
    f"""SELECT deployment_id, count(*) AS total_predictions,
      {settled("coalesce(avg(nullif(confidence_score, 0)), 0)")} AS avg_confidence,
      coalesce(min(nullif(confidence_score, 0)), 0) AS min_confidence,
      coalesce(max(nullif(confidence_score, 0)), 0) AS max_confidence,
      {settled("coalesce(avg(nullif(prediction_time, 0)), 0)", 4)} AS avg_prediction_time,
      {settled("count(*) / CAST(24 AS DOUBLE)")} AS predictions_per_hour
    FROM prediction_logs WHERE {RECENT_DAY} GROUP BY 1""",
)
def _(t: Tables):
    stats = usage.prediction_statistics(t.logs, AS_OF)
    return _settle(_settle(stats, "avg_confidence", "predictions_per_hour"), "avg_prediction_time", digits=4)


@query(
    "A1_sentiment_distribution",
    "prediction_logs",
    f"""SELECT deployment_id, predicted_sentiment AS value, count(*) AS n FROM prediction_logs
    WHERE {RECENT_DAY} GROUP BY 1, 2""",
)
def _(t: Tables):
    return usage.distribution(
        filters.since(t.logs, "predicted_at", AS_OF, hours=24), ["deployment_id"], "predicted_sentiment"
    )


@query(
    "A2_J1_deployment_metrics",
    "prediction_logs model_deployments",
    f"""WITH used AS (SELECT deployment_id, count(*) AS n, sum(coalesce(prediction_time, 0)) AS t,
        sum(coalesce(confidence_score, 0)) AS c FROM prediction_logs WHERE {RECENT_WEEK} GROUP BY 1)
    SELECT d.id AS deployment_id, deployment_name, status, n AS total_predictions,
      {settled("t / n", 4)} AS avg_prediction_time_ms, {settled("c / n")} AS avg_confidence_score,
      {settled("n / CAST(7 AS DOUBLE)")} AS predictions_per_day
    FROM model_deployments d LEFT JOIN used u ON u.deployment_id = d.id""",
)
def _(t: Tables):
    metrics = usage.deployment_metrics(t.deployments, t.logs, AS_OF)
    metrics = _settle(metrics, "avg_confidence_score", "predictions_per_day")
    return _settle(metrics, "avg_prediction_time_ms", digits=4)


@query(
    "A6_daily_performance",
    "prediction_logs",
    f"""SELECT deployment_id, CAST(predicted_at AS DATE) AS prediction_date,
      {settled("avg(confidence_score)")} AS avg_confidence, count(*) AS prediction_count,
      {settled("avg(prediction_time)", 4)} AS avg_prediction_time
    FROM prediction_logs GROUP BY 1, 2""",
)
def _(t: Tables):
    daily = _settle(usage.daily_performance(t.logs), "avg_confidence")
    return _settle(daily, "avg_prediction_time", digits=4)


@query(
    "A7_snapshot",
    "prediction_logs",
    f"""SELECT count(*) AS total_predictions, {settled("avg(confidence_score)")} AS avg_confidence,
      {settled("stddev_samp(confidence_score)")} AS confidence_stddev,
      count(*) FILTER (WHERE confidence_score < 0.6) AS low_confidence_count,
      count(*) FILTER (WHERE predicted_sentiment = 'POSITIVE') AS positive_count,
      count(*) FILTER (WHERE predicted_sentiment = 'NEGATIVE') AS negative_count,
      {settled("avg(prediction_time)", 4)} AS avg_prediction_time_ms,
      {settled("count(*) FILTER (WHERE confidence_score < 0.6) / CAST(count(*) AS DOUBLE)")} AS low_confidence_rate
    FROM prediction_logs WHERE {RECENT_DAY}""",
)
def _(t: Tables):
    row = _settle(usage.snapshot(t.logs, AS_OF), "avg_confidence", "confidence_stddev", "low_confidence_rate")
    return _settle(row, "avg_prediction_time_ms", digits=4)


@query(
    "A8_hourly_volume",
    "prediction_logs",
    f"""SELECT CAST(date_trunc('hour', predicted_at) AS TIMESTAMP) AS hour, count(*) AS predictions,
      {settled("avg(confidence_score)")} AS avg_confidence FROM prediction_logs GROUP BY 1""",
)
def _(t: Tables):
    return _settle(usage.hourly_volume(t.logs), "avg_confidence")


@query(
    "A10_label_distribution",
    "prediction_logs",
    "SELECT deployment_id, predicted_label AS value, count(*) AS n FROM prediction_logs GROUP BY 1, 2",
)
def _(t: Tables):
    return usage.distribution(t.logs, ["deployment_id"], "predicted_label")


@query(
    "A10_null_is_a_value",
    "prediction_logs",
    "SELECT deployment_id, is_correct AS value, count(*) AS n FROM prediction_logs GROUP BY 1, 2",
)
def _(t: Tables):
    return usage.distribution(t.logs, ["deployment_id"], "is_correct")


@query(
    "A19_model_metrics",
    "prediction_logs",
    f"""SELECT deployment_id, count(*) AS total_predictions,
      {settled("coalesce(avg(nullif(prediction_time, 0)), 0)", 4)} AS avg_prediction_time_ms,
      {settled("count(*) / CAST(24 AS DOUBLE)")} AS predictions_per_hour,
      {settled("coalesce(avg(nullif(confidence_score, 0)), 0)")} AS avg_confidence_score,
      count(*) FILTER (WHERE confidence_score < 0.6) AS low_confidence_predictions,
      {settled("count(*) FILTER (WHERE is_error) / CAST(count(*) AS DOUBLE)")} AS error_rate
    FROM prediction_logs WHERE {RECENT_DAY} GROUP BY 1""",
)
def _(t: Tables):
    metrics = usage.model_metrics(t.logs, AS_OF)
    metrics = _settle(metrics, "predictions_per_hour", "avg_confidence_score", "error_rate")
    return _settle(metrics, "avg_prediction_time_ms", digits=4)


@query(
    "A20_request_counters",
    "prediction_logs",
    """SELECT endpoint, CASE WHEN is_error THEN '500' ELSE '200' END AS status, 'POST' AS method, count(*) AS total
    FROM prediction_logs GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    requests = t.logs.withColumns(
        {"method": F.lit("POST"), "status": F.when(F.col("is_error"), "500").otherwise("200")}
    )
    return usage.counter(requests, ["method", "endpoint", "status"])


@query(
    "A20_prediction_counters",
    "prediction_logs",
    "SELECT deployment_id, predicted_sentiment, count(*) AS total FROM prediction_logs GROUP BY 1, 2",
)
def _(t: Tables):
    return usage.counter(t.logs, ["deployment_id", "predicted_sentiment"])


@query(
    "A20_error_counters",
    "prediction_logs",
    """SELECT 'PredictionError' AS error_type, endpoint, model_version, count(*) AS total FROM prediction_logs
    WHERE is_error GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    errors = t.logs.filter("is_error").withColumn("error_type", F.lit("PredictionError"))
    return usage.counter(errors, ["error_type", "endpoint", "model_version"])


@query(
    "A20_database_query_counters",
    "",
    """SELECT CASE event_type WHEN 'view' THEN 'SELECT' WHEN 'click' THEN 'SELECT' WHEN 'error' THEN 'DELETE'
        WHEN 'signup' THEN 'INSERT' ELSE 'UPDATE' END AS operation,
      CASE event_type WHEN 'error' THEN 'monitoring_alerts' ELSE 'prediction_logs' END AS table_name,
      count(*) AS total FROM events GROUP BY 1, 2""",
)
def _(t: Tables):
    touched = t.raw("events").selectExpr(
        "CASE event_type WHEN 'view' THEN 'SELECT' WHEN 'click' THEN 'SELECT' WHEN 'error' THEN 'DELETE' "
        "WHEN 'signup' THEN 'INSERT' ELSE 'UPDATE' END AS operation",
        "CASE event_type WHEN 'error' THEN 'monitoring_alerts' ELSE 'prediction_logs' END AS table_name",
    )
    return usage.counter(touched, ["operation", "table_name"])


@query(
    "A22_sentiment_share",
    "prediction_logs",
    f"""SELECT predicted_sentiment, count(*) AS n,
      {settled("count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)")} AS share FROM prediction_logs GROUP BY 1""",
)
def _(t: Tables):
    return _settle(usage.sentiment_share(t.logs), "share")


@query(
    "A24_label_entropy",
    "prediction_logs",
    f"""WITH c AS (SELECT deployment_id, predicted_sentiment, count(*) AS n FROM prediction_logs GROUP BY 1, 2),
      p AS (SELECT deployment_id, n, n / CAST(sum(n) OVER (PARTITION BY deployment_id) AS DOUBLE) AS p FROM c)
    SELECT deployment_id, {settled("-sum(p * log2(p))")} AS entropy, CAST(sum(n) AS BIGINT) AS predictions
    FROM p GROUP BY 1""",
)
def _(t: Tables):
    return _settle(usage.label_entropy(t.logs), "entropy")


@query(
    "A25_confidence_summary",
    "prediction_logs",
    f"""SELECT predicted_sentiment, {settled("avg(confidence_score)")} AS mean_confidence,
      min(confidence_score) AS min_confidence, max(confidence_score) AS max_confidence
    FROM prediction_logs GROUP BY 1""",
)
def _(t: Tables):
    return _settle(usage.confidence_summary(t.logs, ["predicted_sentiment"]), "mean_confidence")


@query(
    "A26_deployment_gauges",
    "prediction_logs model_deployments",
    f"""WITH c AS (SELECT deployment_id, avg(confidence_score) AS a FROM prediction_logs GROUP BY 1)
    SELECT d.id AS deployment_id, coalesce(avg_response_time, 0) AS avg_response_time,
      {settled("a")} AS avg_confidence
    FROM model_deployments d LEFT JOIN c ON c.deployment_id = d.id WHERE status = 'ACTIVE'""",
)
def _(t: Tables):
    return _settle(usage.deployment_gauges(t.deployments, t.logs), "avg_confidence")


@query(
    "A27_feedback_accuracy",
    "prediction_logs feedback",
    f"""SELECT deployment_id, model_version, count(*) AS feedback_count,
      {settled("avg(CAST(f.is_correct AS INT))")} AS accuracy, {settled("avg(feedback_score)")} AS avg_feedback_score
    FROM feedback f JOIN prediction_logs p ON p.id = f.prediction_id GROUP BY 1, 2""",
)
def _(t: Tables):
    return _settle(usage.feedback_accuracy(t.feedback, t.logs), "accuracy", "avg_feedback_score")


@query(
    "P1_lookback",
    "prediction_logs",
    f"SELECT id, deployment_id, predicted_at FROM prediction_logs WHERE {RECENT_DAY}",
)
def _(t: Tables):
    return filters.since(t.logs, "predicted_at", AS_OF, hours=24).select("id", "deployment_id", "predicted_at")


@query(
    "P2_run_by_id",
    "experiment_runs",
    "SELECT id, experiment_name, status FROM experiment_runs WHERE id = 42",
)
def _(t: Tables):
    return filters.one_by_value(t.runs, id=42).select("id", "experiment_name", "status")


@query(
    "P2_run_by_external_id",
    "experiment_runs",
    "SELECT id, mlflow_run_id, run_name FROM experiment_runs WHERE mlflow_run_id = 'mlf-7'",
)
def _(t: Tables):
    return filters.one_by_value(t.runs, mlflow_run_id="mlf-7").select("id", "mlflow_run_id", "run_name")


@query(
    "P2_deployment_by_id",
    "model_deployments",
    "SELECT id, deployment_name, status FROM model_deployments WHERE id = 'dep-3'",
)
def _(t: Tables):
    return filters.one_by_value(t.deployments, id="dep-3").select("id", "deployment_name", "status")


@query(
    "P2_active_deployments",
    "model_deployments",
    "SELECT id, deployment_name, status, avg_response_time FROM model_deployments WHERE status = 'ACTIVE'",
)
def _(t: Tables):
    found = filters.by_value(t.deployments, status="ACTIVE")
    return found.select("id", "deployment_name", "status", "avg_response_time")


@query(
    "P2_active_alerts_by_severity",
    "monitoring_alerts",
    "SELECT id, alert_type, triggered_at FROM monitoring_alerts WHERE status = 'ACTIVE' AND severity = 'HIGH'",
)
def _(t: Tables):
    return filters.by_value(t.alerts, status="ACTIVE", severity="HIGH").select("id", "alert_type", "triggered_at")


@query(
    "P3_low_confidence",
    "prediction_logs",
    """SELECT deployment_id, count(*) FILTER (WHERE confidence_score < 0.5) AS anomalies,
      count(*) FILTER (WHERE confidence_score < 0.6) AS low_confidence FROM prediction_logs GROUP BY 1""",
)
def _(t: Tables):
    return t.logs.groupBy("deployment_id").agg(
        F.count_if(F.col("confidence_score") < usage.ANOMALY_CONFIDENCE).alias("anomalies"),
        F.count_if(F.col("confidence_score") < usage.LOW_CONFIDENCE).alias("low_confidence"),
    )


@query("P4_input_hash", "", "SELECT doc_id, sha256(text) AS input_hash FROM documents")
def _(t: Tables):
    return t.raw("documents").select("doc_id", input_hash(F.col("text")).alias("input_hash"))


@query(
    "P13_json_fields",
    "prediction_logs",
    """SELECT id, CAST(json_extract(metadata, '$.k') AS INT) AS k FROM prediction_logs""",
)
def _(t: Tables):
    return t.logs.select("id", F.get_json_object("metadata", "$.k").cast("int").alias("k"))


@query(
    "P13_hyperparameters",
    "experiment_runs",
    "SELECT id, epochs, learning_rate FROM experiment_runs",
)
def _(t: Tables):
    parsed = F.from_json("hyperparameters", "learning_rate DOUBLE, epochs INT")
    return t.runs.select("id", parsed["epochs"].alias("epochs"), parsed["learning_rate"].alias("learning_rate"))


@query(
    "P14_milliseconds_to_seconds",
    "prediction_logs",
    "SELECT id, prediction_time / 1000 AS duration_seconds FROM prediction_logs",
)
def _(t: Tables):
    return t.logs.select("id", (F.col("prediction_time") / 1000).alias("duration_seconds"))


@query(
    "P16_text_preview",
    "",
    """SELECT doc_id, CASE WHEN length(text) > 50 THEN concat(substr(text, 1, 50), '...') ELSE text END AS preview
    FROM documents""",
)
def _(t: Tables):
    return t.raw("documents").select("doc_id", preview(F.col("text")).alias("preview"))


@query(
    "P10_status_bands",
    "prediction_logs",
    f"""WITH s AS (SELECT deployment_id, avg(confidence_score) AS c,
        count(*) FILTER (WHERE confidence_score < 0.6) / CAST(count(*) AS DOUBLE) AS low,
        avg(prediction_time) AS ms, count(*) FILTER (WHERE is_error) / CAST(count(*) AS DOUBLE) AS err,
        CAST(predicted_at AS DATE) AS day FROM prediction_logs GROUP BY deployment_id, CAST(predicted_at AS DATE))
    SELECT deployment_id, day,
      CASE WHEN c >= 0.8 THEN 'healthy' WHEN c >= 0.6 THEN 'warning' ELSE 'critical' END AS confidence_status,
      CASE WHEN low <= 0.1 THEN 'healthy' WHEN low <= 0.3 THEN 'warning' ELSE 'critical' END AS low_confidence_status,
      CASE WHEN ms <= 100 THEN 'healthy' WHEN ms <= 500 THEN 'warning' WHEN ms IS NOT NULL THEN 'critical' END
        AS latency_status,
      CASE WHEN err <= 0 THEN 'healthy' WHEN err <= 0.01 THEN 'warning' ELSE 'critical' END AS error_status
    FROM s""",
)
def _(t: Tables):
    from tallywatch.operators.health import status_bands

    daily = t.logs.groupBy("deployment_id", F.to_date("predicted_at").alias("day"))
    return status_bands(
        daily.agg(
            F.avg("confidence_score").alias("avg_confidence"),
            (F.count_if(F.col("confidence_score") < 0.6) / F.count("*")).alias("low_confidence_rate"),
            F.avg("prediction_time").alias("latency_ms"),
            (F.count_if("is_error") / F.count("*")).alias("error_rate"),
        )
    ).select("deployment_id", "day", "confidence_status", "low_confidence_status", "latency_status", "error_status")


@query(
    "P10b_dashboard_bands",
    "prediction_logs",
    """WITH m AS (SELECT CAST(date_trunc('hour', predicted_at) AS TIMESTAMP) AS hour, avg(confidence_score) AS c,
        avg(prediction_time) / 1000 AS s, count(*) FILTER (WHERE is_error) / CAST(60 AS DOUBLE) AS e,
        CAST(count(*) AS DOUBLE) AS r FROM prediction_logs GROUP BY 1)
    SELECT hour, CASE WHEN c < 0.6 THEN 'red' WHEN c < 0.8 THEN 'yellow' ELSE 'green' END AS confidence_band,
      CASE WHEN s < 0.1 THEN 'green' WHEN s < 0.5 THEN 'yellow' WHEN s IS NOT NULL THEN 'red' END AS latency_band,
      CASE WHEN c < 0.6 THEN 'red' WHEN c < 0.7 THEN 'orange' WHEN c < 0.8 THEN 'yellow' ELSE 'green' END
        AS confidence_series_band,
      CASE WHEN e < 1 THEN 'green' ELSE 'red' END AS error_band,
      CASE WHEN r < 5 THEN 'green' WHEN r < 10 THEN 'yellow' ELSE 'red' END AS requests_band FROM m""",
)
def _(t: Tables):
    from tallywatch.operators.health import dashboard_bands

    hourly = t.logs.groupBy(F.window("predicted_at", "1 hour"))
    measured = hourly.agg(
        F.avg("confidence_score").alias("confidence"),
        (F.avg("prediction_time") / 1000).alias("latency_s"),
        (F.count_if("is_error") / F.lit(60.0)).alias("errors_per_min"),
        F.count("*").cast("double").alias("active_requests"),
    ).withColumn("confidence_series", F.col("confidence"))
    return dashboard_bands(measured).selectExpr(
        "window.start AS hour", "confidence_band", "latency_s_band AS latency_band", "confidence_series_band",
        "errors_per_min_band AS error_band", "active_requests_band AS requests_band",
    )


@query(
    "P10c_accuracy_bands",
    "experiment_runs",
    """SELECT id, accuracy, CASE WHEN accuracy IS NULL THEN NULL WHEN accuracy < 0.6 THEN 'Poor'
      WHEN accuracy < 0.7 THEN 'Fair' WHEN accuracy < 0.8 THEN 'Good' WHEN accuracy < 0.9 THEN 'Very Good'
      WHEN accuracy <= 0.95 THEN 'Excellent' ELSE 'Outstanding' END AS quality FROM experiment_runs""",
)
def _(t: Tables):
    from tallywatch.operators.health import accuracy_band

    return t.runs.select("id", "accuracy", accuracy_band(F.col("accuracy")).alias("quality"))


@query(
    "J8_logs_of_active_deployments",
    "prediction_logs model_deployments",
    """SELECT deployment_id, count(*) AS n FROM prediction_logs
    WHERE deployment_id IN (SELECT id FROM model_deployments WHERE status = 'ACTIVE') GROUP BY 1""",
)
def _(t: Tables):
    return usage.logs_of_active(t.deployments, t.logs).groupBy("deployment_id").agg(F.count("*").alias("n"))


@query(
    "J10_idle_deployments",
    "prediction_logs model_deployments",
    f"""SELECT id, deployment_name FROM model_deployments WHERE id NOT IN
    (SELECT deployment_id FROM prediction_logs WHERE {RECENT_WEEK})""",
)
def _(t: Tables):
    return usage.idle_deployments(t.deployments, t.logs, AS_OF).select("id", "deployment_name")


@query(
    "J2_feedback_predictions",
    "prediction_logs feedback",
    """SELECT prediction_id, f.is_correct, feedback_score, deployment_id, model_version, predicted_label,
      confidence_score FROM feedback f JOIN prediction_logs p ON p.id = f.prediction_id""",
)
def _(t: Tables):
    return usage.feedback_joined(t.feedback, t.logs).drop("comments")


@query(
    "W5_prediction_page",
    "prediction_logs",
    """SELECT id, deployment_id, predicted_at FROM prediction_logs WHERE deployment_id = 'dep-1'
    ORDER BY predicted_at DESC, id DESC LIMIT 1000 OFFSET 50""",
)
def _(t: Tables):
    rows = filters.by_value(t.logs, deployment_id="dep-1").select("id", "deployment_id", "predicted_at")
    return filters.newest(rows, "predicted_at", 1000, offset=50)


@query(
    "W6_anomalies",
    "prediction_logs",
    """SELECT id, confidence_score, predicted_at FROM prediction_logs WHERE deployment_id = 'dep-2'
    AND confidence_score < 0.5 ORDER BY predicted_at DESC, id DESC LIMIT 100""",
)
def _(t: Tables):
    low = usage.anomalies(filters.by_value(t.logs, deployment_id="dep-2"))
    return filters.newest(low.select("id", "confidence_score", "predicted_at"), "predicted_at", 100)


@query(
    "W7_recent_predictions",
    "prediction_logs",
    """SELECT id, predicted_sentiment, confidence_score, predicted_at FROM prediction_logs
    ORDER BY predicted_at DESC, id DESC LIMIT 5""",
)
def _(t: Tables):
    rows = t.logs.select("id", "predicted_sentiment", "confidence_score", "predicted_at")
    return filters.newest(rows, "predicted_at", 5)


@query(
    "W11_window_sample",
    "prediction_logs",
    f"""SELECT id, predicted_at FROM prediction_logs WHERE deployment_id = 'dep-1' AND {RECENT_WEEK}
    ORDER BY predicted_at DESC, id DESC LIMIT 1000""",
)
def _(t: Tables):
    recent = filters.since(filters.by_value(t.logs, deployment_id="dep-1"), "predicted_at", AS_OF, days=7)
    return filters.newest(recent.select("id", "predicted_at"), "predicted_at", 1000)


@query(
    "T7_latest_gauge",
    "prediction_logs",
    """SELECT deployment_id, model_version, arg_max(CASE WHEN is_error THEN 0 ELSE 1 END, (predicted_at, id)) AS value
    FROM prediction_logs GROUP BY 1, 2""",
)
def _(t: Tables):
    loaded = t.logs.withColumn("loaded", F.when(F.col("is_error"), 0).otherwise(1))
    return usage.latest_gauge(loaded, ["deployment_id", "model_version"], "loaded", ["predicted_at", "id"])
