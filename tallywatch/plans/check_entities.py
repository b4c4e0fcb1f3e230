"""Checked queries over runs, deployments, dataset metrics and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions.numeric import settle
from tallywatch.operators import alerts, datasets, experiments, filters, folds, health
from tallywatch.plans.registry import query, settled
from tallywatch.sources.canonical import Tables

ALERTS_AS_OF = "2001-08-02 00:00:00"
ALERTS_RECENT = f"triggered_at >= TIMESTAMP '{ALERTS_AS_OF}' - INTERVAL 7 DAY"


def _settle(df, *columns, digits=6):
    return df.withColumns({c: settle(F.col(c), digits) for c in columns})


@query(
    "A3_experiment_summary",
    "experiment_runs",
    f"""SELECT experiment_name, count(*) AS run_count, max(accuracy) AS best_accuracy,
      {settled("avg(accuracy)")} AS avg_accuracy, max(f1_score) AS best_f1_score,
      {settled("avg(f1_score)")} AS avg_f1_score, {settled("avg(training_duration)", 4)} AS avg_training_duration,
      max(created_at) AS last_run_date FROM experiment_runs GROUP BY 1""",
)
def _(t: Tables):
    summary = _settle(experiments.experiment_summary(t.runs), "avg_accuracy", "avg_f1_score")
    return _settle(summary, "avg_training_duration", digits=4)


@query(
    "A3_status_distribution",
    "experiment_runs",
    "SELECT experiment_name, status AS value, count(*) AS n FROM experiment_runs GROUP BY 1, 2",
)
def _(t: Tables):
    from tallywatch.operators.usage import distribution

    return distribution(t.runs, ["experiment_name"], "status")


@query(
    "A4_alert_summary",
    "monitoring_alerts",
    f"""WITH r AS (SELECT * FROM monitoring_alerts WHERE {ALERTS_RECENT})
    SELECT CASE WHEN grouping(status, severity, alert_type) = 7 THEN 'total'
        WHEN grouping(status, severity, alert_type) = 3 THEN 'status'
        WHEN grouping(status, severity, alert_type) = 5 THEN 'severity' ELSE 'alert_type' END AS dimension,
      coalesce(status, severity, alert_type) AS value, count(*) AS n,
      CASE WHEN grouping(status, severity, alert_type) = 7 THEN {settled(
        "avg(CASE WHEN status = 'RESOLVED' AND resolved_at IS NOT NULL THEN "
        "date_diff('second', triggered_at, resolved_at) / CAST(3600 AS DOUBLE) END)")} END AS avg_resolution_time_hours,
      CASE WHEN grouping(status, severity, alert_type) = 7 THEN {settled("count(*) / CAST(7 AS DOUBLE)")} END
        AS alerts_per_day
    FROM r GROUP BY GROUPING SETS ((status), (severity), (alert_type), ())""",
)
def _(t: Tables):
    return _settle(
        alerts.alert_summary(t.alerts, ALERTS_AS_OF), "avg_resolution_time_hours", "alerts_per_day"
    )


@query(
    "A4_alert_summary_all_time",
    "monitoring_alerts",
    f"""SELECT 'total' AS dimension, count(*) AS n, {settled(
      "avg(CASE WHEN status = 'RESOLVED' AND resolved_at IS NOT NULL THEN "
      "date_diff('second', triggered_at, resolved_at) / CAST(3600 AS DOUBLE) END)", 4)} AS avg_resolution_time_hours
    FROM monitoring_alerts WHERE triggered_at >= TIMESTAMP '{ALERTS_AS_OF}' - INTERVAL 4000 DAY""",
)
def _(t: Tables):
    summary = alerts.alert_summary(t.alerts, ALERTS_AS_OF, days=4000).filter(F.col("dimension") == "total")
    return _settle(summary.select("dimension", "n", "avg_resolution_time_hours"), "avg_resolution_time_hours", digits=4)


@query(
    "A5_drift_alert_summary",
    "monitoring_alerts",
    f"""SELECT alert_type, severity, count(*) AS n, CAST(grouping(alert_type, severity) AS BIGINT) AS level
    FROM monitoring_alerts WHERE {ALERTS_RECENT} AND alert_type IN ('DATA_DRIFT', 'MODEL_DRIFT', 'CONCEPT_DRIFT')
    GROUP BY CUBE (alert_type, severity)""",
)
def _(t: Tables):
    return alerts.drift_alert_summary(t.alerts, ALERTS_AS_OF)


@query(
    "A15_stuck_alerts",
    "monitoring_alerts",
    f"""WITH s AS (SELECT count(*) FILTER (WHERE status = 'ACTIVE' AND triggered_at < TIMESTAMP '{ALERTS_AS_OF}'
      - INTERVAL 24 HOUR) AS stuck_alerts FROM monitoring_alerts)
    SELECT stuck_alerts, CASE WHEN stuck_alerts > 5 THEN 'degraded' ELSE 'healthy' END AS status FROM s""",
)
def _(t: Tables):
    return health.alert_system_health(t.alerts, filters.moment(ALERTS_AS_OF))


@query(
    "A16_active_alerts",
    "monitoring_alerts",
    "SELECT severity, alert_type, count(*) AS n FROM monitoring_alerts WHERE status = 'ACTIVE' GROUP BY 1, 2",
)
def _(t: Tables):
    return alerts.active_alert_gauge(t.alerts)


@query(
    "A17_health_rollup",
    "prediction_logs",
    """WITH d AS (SELECT deployment_id, CAST(predicted_at AS DATE) AS day, avg(confidence_score) AS c,
        count(*) FILTER (WHERE is_error) / CAST(count(*) AS DOUBLE) AS e, max(prediction_time) AS m
      FROM prediction_logs GROUP BY 1, 2),
      r AS (SELECT deployment_id, day,
        greatest(CASE WHEN c < 0.6 THEN 3 WHEN c < 0.8 THEN 1 ELSE 0 END, CASE WHEN e > 0.2 THEN 2 ELSE 0 END,
          CASE WHEN m > 300 THEN 1 ELSE 0 END) AS worst FROM d)
    SELECT deployment_id, day, CASE worst WHEN 3 THEN 'critical' WHEN 2 THEN 'unhealthy' WHEN 1 THEN 'degraded'
      ELSE 'healthy' END AS overall_status, CAST(3 AS BIGINT) AS components FROM r""",
)
def _(t: Tables):
    daily = t.logs.groupBy("deployment_id", F.to_date("predicted_at").alias("day")).agg(
        F.avg("confidence_score").alias("c"),
        (F.count_if("is_error") / F.count("*")).alias("e"),
        F.max("prediction_time").alias("m"),
    )
    statuses = F.array(
        F.when(F.col("c") < 0.6, "critical").when(F.col("c") < 0.8, "degraded").otherwise("healthy"),
        F.when(F.col("e") > 0.2, "unhealthy").otherwise("healthy"),
        F.when(F.col("m") > 300, "degraded").otherwise("healthy"),
    )
    return health.overall_health(
        daily.select("deployment_id", "day", F.explode(statuses).alias("status")), ["deployment_id", "day"]
    )


@query(
    "A17_health_alerts",
    "prediction_logs",
    """WITH r AS (SELECT deployment_id, CASE WHEN avg(confidence_score) < 0.6 THEN 'critical'
        WHEN count(*) FILTER (WHERE is_error) / CAST(count(*) AS DOUBLE) > 0.2 THEN 'unhealthy' ELSE 'healthy' END AS s
      FROM prediction_logs GROUP BY deployment_id, CAST(predicted_at AS DATE))
    SELECT 'SYSTEM_HEALTH' AS alert_type, CASE WHEN s = 'critical' THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
      'System Health: ' || upper(s) AS title, 'System health status: ' || s AS description
    FROM r WHERE s IN ('critical', 'unhealthy')""",
)
def _(t: Tables):
    daily = t.logs.groupBy("deployment_id", F.to_date("predicted_at").alias("day")).agg(
        F.avg("confidence_score").alias("c"), (F.count_if("is_error") / F.count("*")).alias("e")
    )
    statuses = F.array(
        F.when(F.col("c") < 0.6, "critical").otherwise("healthy"),
        F.when(F.col("e") > 0.2, "unhealthy").otherwise("healthy"),
    )
    components = daily.select("deployment_id", "day", F.explode(statuses).alias("status"))
    return alerts.health_alerts(health.overall_health(components, ["deployment_id", "day"]))


@query(
    "A18_alert_totals",
    "monitoring_alerts",
    """SELECT count(*) AS total_alerts, count(*) FILTER (WHERE status = 'ACTIVE') AS active_alerts,
      count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alerts FROM monitoring_alerts""",
)
def _(t: Tables):
    return alerts.alert_totals(t.alerts)


@query(
    "J3_runs_of_deployments",
    "model_deployments experiment_runs",
    """SELECT d.id, d.deployment_name, d.experiment_run_id, r.experiment_name, r.run_name, r.f1_score
    FROM model_deployments d LEFT JOIN experiment_runs r ON r.id = d.experiment_run_id""",
)
def _(t: Tables):
    return experiments.runs_of_deployments(t.deployments, t.runs).select(
        "id", "deployment_name", "experiment_run_id", "experiment_name", "run_name", "f1_score"
    )


@query(
    "J4_alerts_with_deployments",
    "monitoring_alerts model_deployments",
    """SELECT a.id, a.alert_type, a.deployment_id, d.deployment_name, d.status AS deployment_status
    FROM monitoring_alerts a LEFT JOIN model_deployments d ON d.id = a.deployment_id""",
)
def _(t: Tables):
    return alerts.alerts_with_deployments(t.alerts, t.deployments).select(
        "id", "alert_type", "deployment_id", "deployment_name", "deployment_status"
    )


@query(
    "P11_P12_alert_texts",
    "monitoring_alerts",
    """SELECT id, CASE WHEN metric_value / 500000 > 0.3 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
      CASE alert_type WHEN 'DATA_DRIFT' THEN 'Data Drift Detected' WHEN 'CONCEPT_DRIFT' THEN 'Concept Drift Detected'
        WHEN 'MODEL_DRIFT' THEN 'Model Drift Detected' WHEN 'PERFORMANCE' THEN 'Performance Detected'
        ELSE 'System Health Detected' END AS title,
      printf('Drift detected with score %.3f', floor(metric_value) / 1000) AS description
    FROM monitoring_alerts""",
)
def _(t: Tables):
    score = F.col("metric_value")
    return t.alerts.select(
        "id",
        alerts.drift_severity(score / 500000).alias("severity"),
        alerts.alert_title(F.col("alert_type")).alias("title"),
        alerts.drift_description(F.floor(score) / 1000).alias("description"),
    )


@query(
    "R7_alert_routing",
    "monitoring_alerts",
    """SELECT id, alert_type, severity, CASE WHEN severity IN ('HIGH', 'CRITICAL') THEN 'notify' ELSE 'log' END AS route
    FROM monitoring_alerts WHERE status = 'ACTIVE'""",
)
def _(t: Tables):
    return alerts.routed(t.alerts).select("id", "alert_type", "severity", "route")


@query(
    "U3_drift_alerts_only",
    "monitoring_alerts",
    """SELECT id, alert_type FROM monitoring_alerts WHERE alert_type IN ('DATA_DRIFT', 'MODEL_DRIFT', 'CONCEPT_DRIFT')
    AND severity IN ('HIGH', 'CRITICAL')""",
)
def _(t: Tables):
    from tallywatch.schemas import DRIFT_ALERT_TYPES, NOTIFY_SEVERITY

    drift = filters.within(t.alerts, "alert_type", DRIFT_ALERT_TYPES)
    return filters.within(drift, "severity", NOTIFY_SEVERITY).select("id", "alert_type")


@query(
    "W1_best_runs",
    "experiment_runs",
    """SELECT id, experiment_name, f1_score FROM experiment_runs WHERE f1_score IS NOT NULL
    ORDER BY f1_score DESC, id LIMIT 10""",
)
def _(t: Tables):
    return experiments.best_runs(t.runs).select("id", "experiment_name", "f1_score")


@query(
    "W1_best_runs_per_experiment",
    "experiment_runs",
    """SELECT id, experiment_name, accuracy, rank FROM (SELECT *, row_number() OVER (PARTITION BY experiment_name
      ORDER BY accuracy DESC, id) AS rank FROM experiment_runs WHERE accuracy IS NOT NULL) WHERE rank <= 3""",
)
def _(t: Tables):
    best = experiments.best_runs_per_experiment(t.runs, "accuracy", 3)
    return best.select("id", "experiment_name", "accuracy", "rank")


@query(
    "W2_latest_metrics",
    "dataset_metrics",
    """SELECT dataset_name, split_name, computed_at, num_examples, quality_score FROM (SELECT *, row_number() OVER
      (PARTITION BY dataset_name, split_name ORDER BY computed_at DESC) AS rn FROM dataset_metrics) WHERE rn = 1""",
)
def _(t: Tables):
    return datasets.latest_metrics(t.dataset_metrics).select(
        "dataset_name", "split_name", "computed_at", "num_examples", "quality_score"
    )


@query(
    "W3_drift_history",
    "dataset_metrics",
    """SELECT dataset_name, split_name, computed_at, drift_score FROM dataset_metrics WHERE drift_score IS NOT NULL
      AND computed_at >= (SELECT max(computed_at) FROM dataset_metrics) - INTERVAL 30 DAY""",
)
def _(t: Tables):
    newest = t.dataset_metrics.select(F.max("computed_at")).scalar()
    since = newest - F.make_dt_interval(F.lit(30), F.lit(0), F.lit(0), F.lit(0.0))
    return datasets.drift_history(t.dataset_metrics, since).select(
        "dataset_name", "split_name", "computed_at", "drift_score"
    )


_DEGRADATION = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY computed_at DESC, split_name) AS rn
      FROM dataset_metrics),
      p AS (SELECT {picked}, c.computed_at, unnest(['quality_score', 'completeness_score', 'consistency_score',
          'validity_score']) AS metric,
        unnest([c.quality_score, c.completeness_score, c.consistency_score, c.validity_score]) AS current_value,
        unnest([p.quality_score, p.completeness_score, p.consistency_score, p.validity_score]) AS previous_value
      FROM r c JOIN r p ON c.rn = 1 AND p.rn = 2 AND {match})
    SELECT {out}, computed_at, metric, current_value, previous_value, {fall} AS degradation FROM p
    WHERE nullif(current_value, 0) IS NOT NULL AND nullif(previous_value, 0) IS NOT NULL
      AND previous_value - current_value > {threshold}"""


@query(
    "W4_quality_degradation",
    "dataset_metrics",
    _DEGRADATION.format(
        keys="dataset_name", picked="c.dataset_name", match="c.dataset_name = p.dataset_name", out="dataset_name",
        threshold="0.001", fall=settled("previous_value - current_value"),
    ),
)
def _(t: Tables):
    return _settle(datasets.quality_degradation(t.dataset_metrics, 0.001), "degradation")


@query(
    "W4_quality_degradation_per_split",
    "dataset_metrics",
    _DEGRADATION.format(
        keys="dataset_name, split_name", picked="c.dataset_name, c.split_name",
        match="c.dataset_name = p.dataset_name AND c.split_name = p.split_name", out="dataset_name, split_name",
        threshold="0.001", fall=settled("previous_value - current_value"),
    ),
)
def _(t: Tables):
    return _settle(datasets.quality_degradation(t.dataset_metrics, 0.001, mode="split"), "degradation")


@query(
    "W7_active_alerts",
    "monitoring_alerts",
    """SELECT id, alert_type, severity, triggered_at FROM monitoring_alerts WHERE status = 'ACTIVE'
    ORDER BY triggered_at DESC, id DESC LIMIT 5""",
)
def _(t: Tables):
    active = filters.by_value(t.alerts, status="ACTIVE").select("id", "alert_type", "severity", "triggered_at")
    return filters.newest(active, "triggered_at", 5)


@query(
    "W8_run_updates",
    "experiment_runs run_changes",
    """WITH f AS (SELECT run_id, arg_max_null(value, seq) FILTER (WHERE field = 'status') AS status,
        arg_max_null(value, seq) FILTER (WHERE field = 'accuracy') AS accuracy,
        arg_max_null(value, seq) FILTER (WHERE field = 'f1_score') AS f1_score,
        count(*) FILTER (WHERE field = 'status') AS ns, count(*) FILTER (WHERE field = 'accuracy') AS na,
        count(*) FILTER (WHERE field = 'f1_score') AS nf, arg_max(changed_at, seq) AS updated_at
      FROM run_changes GROUP BY 1)
    SELECT r.id, CASE WHEN ns > 0 THEN f.status ELSE r.status END AS status,
      CASE WHEN na > 0 THEN CAST(f.accuracy AS DOUBLE) ELSE r.accuracy END AS accuracy,
      CASE WHEN nf > 0 THEN CAST(f.f1_score AS DOUBLE) ELSE r.f1_score END AS f1_score, f.updated_at
    FROM experiment_runs r LEFT JOIN f ON f.run_id = r.id""",
)
def _(t: Tables):
    updated = folds.apply_run_updates(t.runs, t.run_changes)
    return updated.select("id", "status", "accuracy", "f1_score", "updated_at")


@query(
    "W8_deployment_updates",
    "deployment_changes",
    """SELECT deployment_id, arg_max(status, seq) FILTER (WHERE status IS NOT NULL) AS status,
      arg_max(health_status, seq) FILTER (WHERE health_status IS NOT NULL) AS health_status,
      arg_max(request_count, seq) FILTER (WHERE request_count IS NOT NULL) AS request_count,
      arg_max(avg_response_time, seq) FILTER (WHERE avg_response_time IS NOT NULL) AS avg_response_time,
      arg_max(error_rate, seq) FILTER (WHERE error_rate IS NOT NULL) AS error_rate,
      arg_max(changed_at, seq) FILTER (WHERE status IS NOT NULL) AS last_health_check,
      arg_max(changed_at, seq) FILTER (WHERE request_count IS NOT NULL OR avg_response_time IS NOT NULL
        OR error_rate IS NOT NULL) AS updated_at
    FROM deployment_changes GROUP BY 1""",
)
def _(t: Tables):
    return folds.fold_deployment_updates(t.deployment_changes)


LIFECYCLE = """WITH e AS (SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY seq) AS rn FROM alert_events),
      f AS (SELECT alert_id, bool_or(action = 'resolve') AS resolved, bool_or(rn = 1 AND action = 'acknowledge') AS acked,
        arg_max(happened_at, seq) FILTER (WHERE action = 'resolve') AS resolved_at,
        arg_max(actor, seq) FILTER (WHERE action = 'resolve') AS resolved_by,
        arg_max(notes, seq) FILTER (WHERE action = 'resolve' AND notes IS NOT NULL) AS notes,
        max(happened_at) FILTER (WHERE rn = 1) AS first_at, max(actor) FILTER (WHERE rn = 1) AS first_actor
      FROM e GROUP BY 1),
      s AS (SELECT a.id AS alert_id, a.status AS first_status, f.*,
        coalesce(a.status = 'ACTIVE' AND f.acked, false) AS ok FROM monitoring_alerts a LEFT JOIN f ON f.alert_id = a.id)
    SELECT alert_id, first_status, CASE WHEN resolved THEN 'RESOLVED' WHEN ok THEN 'ACKNOWLEDGED' ELSE first_status END
        AS status, CASE WHEN ok THEN first_at END AS acknowledged_at, resolved_at, resolved_by,
      coalesce(notes, CASE WHEN ok THEN 'Acknowledged by: ' || first_actor END) AS resolution_notes FROM s"""


@query("W9_alert_lifecycle", "monitoring_alerts alert_events", LIFECYCLE)
def _(t: Tables):
    return folds.alert_lifecycle(t.alerts, t.alert_events)


@query(
    "W16_best_checkpoint",
    "checkpoints",
    """SELECT run_id, epoch, step, eval_f1, eval_loss FROM (SELECT *, row_number() OVER (PARTITION BY run_id
      ORDER BY eval_f1 DESC, epoch, step) AS rn FROM checkpoints) WHERE rn = 1""",
)
def _(t: Tables):
    return experiments.best_checkpoint(t.checkpoints, ["run_id"], tie=["epoch", "step"])


@query(
    "W16_lowest_loss_checkpoint",
    "checkpoints",
    """SELECT run_id, epoch, step, eval_f1, eval_loss FROM (SELECT *, row_number() OVER (PARTITION BY run_id
      ORDER BY eval_loss, epoch, step) AS rn FROM checkpoints) WHERE rn = 1""",
)
def _(t: Tables):
    return experiments.best_checkpoint(
        t.checkpoints, ["run_id"], metric="eval_loss", highest=False, tie=["epoch", "step"]
    )


@query(
    "W17_metric_changes",
    "experiment_runs",
    f"""WITH l AS (SELECT experiment_name, created_at, id, f1_score, lag(f1_score) OVER (PARTITION BY experiment_name
      ORDER BY created_at, id) AS previous FROM experiment_runs)
    SELECT *, {settled("f1_score - previous")} AS change FROM l""",
)
def _(t: Tables):
    return _settle(experiments.metric_changes(t.runs), "change")
