"""Table schemas, closed value sets and column defaults."""

from __future__ import annotations

from pyspark.sql import types as T

# Closed string sets.
DEPLOYMENT_STATUS = ("DEPLOYING", "ACTIVE", "INACTIVE", "FAILED")
RUN_STATUS = ("RUNNING", "COMPLETED", "FAILED")
ALERT_TYPES = ("DATA_DRIFT", "CONCEPT_DRIFT", "MODEL_DRIFT", "PERFORMANCE", "SYSTEM_HEALTH", "ERROR")
DRIFT_ALERT_TYPES = ("DATA_DRIFT", "MODEL_DRIFT", "CONCEPT_DRIFT")
ALERT_SEVERITY = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
ALERT_STATUS = ("ACTIVE", "ACKNOWLEDGED", "RESOLVED")
NOTIFY_SEVERITY = ("HIGH", "CRITICAL")
SENTIMENTS = ("POSITIVE", "NEGATIVE")
LABELS = (0, 1)

# Names and types of the tables' columns.
EXPERIMENT_RUNS = (
    "id STRING, mlflow_run_id STRING, experiment_name STRING, run_name STRING, status STRING, model_name STRING,"
    "model_version STRING, dataset_name STRING, accuracy DOUBLE, f1_score DOUBLE, precision DOUBLE, recall DOUBLE,"
    "loss DOUBLE, hyperparameters STRING, training_duration DOUBLE, created_at TIMESTAMP_NTZ,"
    "updated_at TIMESTAMP_NTZ, run_metadata STRING, artifacts_path STRING"
)
MODEL_DEPLOYMENTS = (
    "id STRING, experiment_run_id STRING, deployment_name STRING, version STRING, status STRING, endpoint_url STRING,"
    "api_version STRING, cpu_request STRING, memory_request STRING, cpu_limit STRING, memory_limit STRING,"
    "replicas INT, request_count INT, avg_response_time DOUBLE, error_rate DOUBLE, deployed_at TIMESTAMP_NTZ,"
    "last_health_check TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, deployment_config STRING,"
    "health_status STRING"
)
DATASET_METRICS = (
    "id STRING, dataset_name STRING, version STRING, split_name STRING, num_examples INT, avg_text_length DOUBLE,"
    "min_text_length INT, max_text_length INT, quality_score DOUBLE, completeness_score DOUBLE,"
    "consistency_score DOUBLE, validity_score DOUBLE, label_distribution MAP<STRING,BIGINT>, drift_score DOUBLE,"
    "is_drift_detected BOOLEAN, computed_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, preprocessing_config STRING,"
    "statistics STRING"
)
PREDICTION_LOGS = (
    "id STRING, deployment_id STRING, request_id STRING, input_text STRING, input_hash STRING, predicted_label INT,"
    "predicted_sentiment STRING, confidence_score DOUBLE, probabilities MAP<STRING,DOUBLE>, prediction_time DOUBLE,"
    "model_version STRING, user_agent STRING, ip_address STRING, api_version STRING, predicted_at TIMESTAMP_NTZ,"
    "feedback_score DOUBLE, is_correct BOOLEAN, drift_score DOUBLE"
)
MONITORING_ALERTS = (
    "id STRING, alert_type STRING, severity STRING, status STRING, deployment_id STRING, experiment_run_id STRING,"
    "title STRING, description STRING, metric_name STRING, metric_value DOUBLE, threshold_value DOUBLE,"
    "resolved_by STRING, resolution_notes STRING, triggered_at TIMESTAMP_NTZ, acknowledged_at TIMESTAMP_NTZ,"
    "resolved_at TIMESTAMP_NTZ, alert_data STRING"
)
DRIFT_REPORTS = (
    "id INT, created_at TIMESTAMP_NTZ, report_type STRING, drift_detected BOOLEAN, drift_score DOUBLE, report_data STRING"
)
FEEDBACK = (
    "id INT, created_at TIMESTAMP_NTZ, prediction_id INT, actual_sentiment DOUBLE, user_feedback STRING,"
    "feedback_type STRING"
)

# DDL text of each table; `table_schema` parses it once a session is running
TABLES = {
    "experiment_runs": EXPERIMENT_RUNS,
    "model_deployments": MODEL_DEPLOYMENTS,
    "dataset_metrics": DATASET_METRICS,
    "prediction_logs": PREDICTION_LOGS,
    "monitoring_alerts": MONITORING_ALERTS,
    "drift_reports": DRIFT_REPORTS,
    "feedback": FEEDBACK,
}

# What an appended row gets where the column is NULL or absent; NOW stands for the append time.
NOW = "NOW"
DEFAULTS: dict[str, dict[str, object]] = {
    "experiment_runs": {"status": "RUNNING", "created_at": NOW, "updated_at": NOW},
    "model_deployments": {
        "status": "DEPLOYING",
        "api_version": "v1",
        "replicas": 1,
        "request_count": 0,
        "error_rate": 0.0,
        "created_at": NOW,
        "updated_at": NOW,
        "health_status": "UNKNOWN",
    },
    "dataset_metrics": {"is_drift_detected": False, "computed_at": NOW, "created_at": NOW},
    "prediction_logs": {"predicted_at": NOW},
    "monitoring_alerts": {"severity": "MEDIUM", "status": "ACTIVE", "triggered_at": NOW},
    "drift_reports": {"created_at": NOW, "drift_detected": False},
    "feedback": {"created_at": NOW, "feedback_type": "user"},
}
REQUIRED: dict[str, tuple[str, ...]] = {
    "experiment_runs": ("id", "mlflow_run_id", "experiment_name", "run_name", "model_name", "dataset_name"),
    "model_deployments": ("id", "experiment_run_id", "deployment_name", "version"),
    "dataset_metrics": ("id", "dataset_name", "split_name", "num_examples"),
    "prediction_logs": ("id", "deployment_id", "request_id", "input_text"),
    "monitoring_alerts": ("id", "alert_type", "title"),
    "drift_reports": ("id", "report_type"),
    "feedback": ("id",),
}


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])
