"""Checked queries for sources and sinks, and for streams run to the end of their source."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions.numeric import settle
from tallywatch.functions.sizes import scratch_folder
from tallywatch.operators.datasets import reference_texts
from tallywatch.operators.drift_text import TextReference
from tallywatch.plans.check_drift import MONITOR
from tallywatch.plans.check_entities import LIFECYCLE
from tallywatch.plans.check_usage import AS_OF
from tallywatch.plans.monitor import ChecksFailed, write_monitor
from tallywatch.plans.registry import query, settled
from tallywatch.sources import tables
from tallywatch.sources.canonical import Tables, alert_events_from_lines, logs_from_events
from tallywatch.streaming import drift_watch, jobs, lifecycle

EVERY_TABLE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _settle(df, *columns, digits=6):
    return df.withColumns({c: settle(F.col(c), digits) for c in columns})


@query(
    "S4_prediction_rows",
    "prediction_logs text_logs",
    """SELECT sha256(request_id) AS id, deployment_id, request_id, input_hash, predicted_label, predicted_sentiment,
      confidence_score, prediction_time, model_version, predicted_at FROM text_logs WHERE endpoint <> 'signup'""",
)
def _(t: Tables):
    served = F.when(F.col("endpoint") != "signup", F.col("deployment_id"))
    rows = tables.prediction_rows(t.with_texts(t.logs).drop("id"), served)
    return rows.select(
        "id", "deployment_id", "request_id", "input_hash", "predicted_label", "predicted_sentiment", "confidence_score",
        "prediction_time", "model_version", "predicted_at",
    )


@query(
    "S7_parameterised_sql",
    "prediction_logs",
    """SELECT endpoint, count(*) AS n FROM prediction_logs WHERE confidence_score < 0.4 AND deployment_id = 'dep-3'
    GROUP BY 1""",
)
def _(t: Tables):
    sql = """SELECT endpoint, count(*) AS n FROM prediction_logs
      WHERE confidence_score < :threshold AND deployment_id = :deployment GROUP BY endpoint"""
    return tables.run_sql(t.spark, sql, {"prediction_logs": t.logs}, threshold=0.4, deployment="dep-3")


@query(
    "S8_table_info",
    "",
    """SELECT 'prediction_logs' AS table_name, (SELECT count(*) FROM events) AS row_count, * FROM (VALUES
      (0, 'id', 'bigint', false, NULL), (1, 'deployment_id', 'string', false, NULL), (2, 'predicted_label', 'int', true, NULL),
      (3, 'confidence_score', 'double', true, NULL), (4, 'predicted_at', 'timestamp_ntz', true, 'NOW'))
      v(position, name, type, nullable, "default")""",
)
def _(t: Tables):
    chosen = t.logs.select("id", "deployment_id", "predicted_label", "confidence_score", "predicted_at")
    nullable_label = chosen.withColumn("predicted_label", F.nullif("predicted_label", F.lit(-1)))
    return tables.table_info(nullable_label, "prediction_logs")


@query(
    "S9_table_counts",
    "",
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}" for name in EVERY_TABLE),
)
def _(t: Tables):
    return tables.table_counts({name: t.raw(name) for name in EVERY_TABLE})


def _profile_sql(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS min_value,
        CAST(max({c}) AS VARCHAR) AS max_value, count(DISTINCT {c}) AS n_distinct FROM {table}"""
        for c in columns
    )


PROFILED = ("event_id", "ts", "user_id", "event_type", "value", "props")


@query("S10_column_profile", "", _profile_sql("events", PROFILED))
def _(t: Tables):
    return tables.column_profile(t.raw("events"))


@query(
    "S10_column_profile_with_nulls",
    "prediction_logs",
    _profile_sql("prediction_logs", ("prediction_time", "confidence_score", "is_correct", "predicted_sentiment")),
)
def _(t: Tables):
    return tables.column_profile(t.logs, ["prediction_time", "confidence_score", "is_correct", "predicted_sentiment"])


@query(
    "S10_order_correlation",
    "prediction_logs",
    f"""SELECT 'prediction_time' AS "column", {settled("corr(prediction_time, id)")} AS correlation FROM prediction_logs
    UNION ALL SELECT 'client_id', {settled("corr(client_id, id)")} FROM prediction_logs
    UNION ALL SELECT 'predicted_label', {settled("corr(predicted_label, id)")} FROM prediction_logs""",
)
def _(t: Tables):
    found = tables.order_correlation(t.logs, "id", ["prediction_time", "client_id", "predicted_label"])
    return _settle(found, "correlation")


@query("S10_approximate_profile")
def _(t: Tables):
    return tables.column_profile(t.raw("lineitem"), exact=False)


@query(
    "S10_approximate_within_bound",
    "",
    """SELECT unnest(['l_orderkey', 'l_partkey', 'l_returnflag', 'l_tax']) AS "column", (SELECT count(*) FROM lineitem) AS "rows",
      true AS within_bound""",
)
def _(t: Tables):
    # the sketch's relative error is 5 %; four times that is never left
    names = ["l_orderkey", "l_partkey", "l_returnflag", "l_tax"]
    rough = tables.column_profile(t.raw("lineitem"), names, exact=False)
    exact = tables.column_profile(t.raw("lineitem"), names).select("column", F.col("n_distinct").alias("exact"))
    error = F.abs(F.col("n_distinct") - F.col("exact")) / F.col("exact")
    return rough.join(exact, "column").select("column", "rows", (error <= 0.2).alias("within_bound"))


@query("S2_saved_splits", "labelled_texts", "SELECT doc_id, label, split FROM labelled_texts")
def _(t: Tables):
    path = scratch_folder(t.spark, "splits")
    tables.save_splits(t.labelled_texts.select("doc_id", "label", "split"), path)
    return t.spark.read.parquet(path).select("doc_id", "label", "split")


@query("S3_loaded_or_built", "labelled_texts", "SELECT split, count(*) AS texts FROM labelled_texts GROUP BY 1")
def _(t: Tables):
    path, texts = scratch_folder(t.spark, "built"), t.labelled_texts.select("doc_id", "split")
    tables.load_or_build(t.spark, path, lambda: texts)
    saved = tables.load_or_build(t.spark, path, lambda: texts.limit(0))  # there by now: not built again
    return saved.groupBy("split").agg(F.count("*").alias("texts"))


@query(
    "S5_appended_runs",
    "",
    """SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS experiment_name, 'RUNNING' AS status,
      TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM part""",
)
def _(t: Tables):
    path, now = scratch_folder(t.spark, "runs"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    runs = t.runs.select("id", "mlflow_run_id", "experiment_name", "run_name", F.lit("m").alias("model_name"), F.lit("d").alias("dataset_name"))
    for part in (runs.filter("id % 2 = 0"), runs.filter("id % 2 = 1")):
        tables.append_rows(part, "experiment_runs", path, now)
    return t.spark.read.parquet(path).select("id", "experiment_name", "status", "created_at")


@query(
    "S5_appended_feedback",
    "feedback",
    """SELECT CAST(prediction_id AS INT) AS prediction_id, feedback_score AS actual_sentiment, 'user' AS feedback_type,
      TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM feedback""",
)
def _(t: Tables):
    path, now = scratch_folder(t.spark, "feedback"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    rows = t.feedback.select(
        F.col("prediction_id").alias("id"), "prediction_id", F.col("feedback_score").alias("actual_sentiment"),
        F.col("comments").alias("user_feedback"),
    )
    tables.append_rows(rows, "feedback", path, now)
    return t.spark.read.parquet(path).select("prediction_id", "actual_sentiment", "feedback_type", "created_at")


@query(
    "S5_written_drift_reports",
    "prediction_logs text_logs labelled_texts",
    f"""{MONITOR} SELECT drift_type AS report_type, is_drift_detected AS drift_detected, {settled("drift_score")} AS drift_score
    FROM results WHERE deployment_id IN (SELECT deployment_id FROM busy)""",
)
def _(t: Tables):
    path = scratch_folder(t.spark, "reports")
    reference = TextReference.fit(reference_texts(t.labelled_texts.select("doc_id", "split", "text")))
    write_monitor(path, reference, t.logs, AS_OF, t.with_texts)
    return _settle(t.spark.read.parquet(path).select("report_type", "drift_detected", "drift_score"), "drift_score")


@query(
    "S6_exported_json",
    "model_deployments",
    "SELECT id, deployment_name, status, avg_response_time FROM model_deployments",
)
def _(t: Tables):
    path = scratch_folder(t.spark, "json")
    tables.export_json(t.deployments, path)
    return t.spark.read.schema("id string, deployment_name string, status string, avg_response_time double").json(path)


def _folders(t: Tables, name: str) -> tuple[str, str]:
    base = scratch_folder(t.spark, name)
    return f"{base}/out", f"{base}/checkpoint"


def _finish(job) -> None:
    job.awaitTermination()


def _log_stream(t: Tables):
    return logs_from_events(t.stream("events"))


@query(
    "R1_streamed_log",
    "prediction_logs",
    """SELECT id, deployment_id, request_id, confidence_score, predicted_at, CAST(predicted_at AS DATE) AS predicted_on
    FROM prediction_logs""",
)
def _(t: Tables):
    out, checkpoint = _folders(t, "log")
    _finish(jobs.ingest(_log_stream(t), out, checkpoint))
    return t.spark.read.parquet(out).select(
        "id", "deployment_id", "request_id", "confidence_score", "predicted_at", "predicted_on"
    )


@query(
    "R2_streamed_counters",
    "prediction_logs",
    f"""SELECT CAST(date_trunc('hour', predicted_at) AS TIMESTAMP) AS window_start, endpoint, count(*) AS predictions,
      count(*) FILTER (WHERE is_error) AS errors, {settled("avg(prediction_time)", 4)} AS avg_prediction_time,
      {settled("avg(confidence_score)")} AS avg_confidence FROM prediction_logs
    WHERE date_trunc('hour', predicted_at) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    GROUP BY 1, 2""",
)
def _(t: Tables):
    out, checkpoint = _folders(t, "counters")
    _finish(jobs.start(jobs.windowed_counters(_log_stream(t)), out, checkpoint))
    written = t.spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    return _settle(_settle(written, "avg_confidence"), "avg_prediction_time", digits=4)


@query(
    "R3_streamed_without_repeats",
    "prediction_logs",
    "SELECT DISTINCT client_id || '-' || CAST(predicted_at AS DATE) AS request_id FROM prediction_logs",
)
def _(t: Tables):
    # one request id per client and day, so that ids repeat
    repeated = _log_stream(t).withColumn("request_id", F.concat_ws("-", "client_id", F.to_date("predicted_at")))
    out, checkpoint = _folders(t, "repeats")
    _finish(jobs.start(jobs.drop_repeats(repeated, delay="2 days").select("request_id"), out, checkpoint))
    return t.spark.read.parquet(out)


@query(
    "R4_streamed_low_confidence_alerts",
    "prediction_logs model_deployments",
    """SELECT 'low-confidence-' || p.id AS id, 'PERFORMANCE' AS alert_type, 'MEDIUM' AS severity, 'ACTIVE' AS status,
      deployment_id, 'Low Confidence: ' || deployment_name AS title, 'confidence_score' AS metric_name,
      confidence_score AS metric_value, CAST(0.5 AS DOUBLE) AS threshold_value, predicted_at AS triggered_at
    FROM prediction_logs p JOIN model_deployments d ON d.id = p.deployment_id
    WHERE d.status = 'ACTIVE' AND confidence_score < 0.5""",
)
def _(t: Tables):
    out, checkpoint = _folders(t, "alerts")
    _finish(jobs.start(jobs.low_confidence_alerts(_log_stream(t), t.deployments), out, checkpoint))
    return t.spark.read.parquet(out)


@query(
    "R5_streamed_drift",
    "prediction_logs text_logs labelled_texts",
    f"""{MONITOR} SELECT deployment_id, drift_type, is_drift_detected, {settled("drift_score")} AS drift_score,
      {settled("confidence")} AS confidence FROM results WHERE deployment_id IN (SELECT deployment_id FROM busy)""",
)
def _(t: Tables):
    # the log arrives in several files and batches; the last batch's results must be those of one batch over all rows
    reference = TextReference.fit(reference_texts(t.labelled_texts.select("doc_id", "split", "text")))
    out, checkpoint = _folders(t, "drift")
    arriving, events = scratch_folder(t.spark, "arriving"), t.raw("events")
    events.repartition(4, "event_id").write.parquet(arriving)
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    _finish(drift_watch.watch_drift(logs_from_events(stream), reference, out, checkpoint, t.with_texts, as_of=AS_OF))
    found = t.spark.read.parquet(f"{out}/results")
    found = found.filter(F.col("batch") == found.select(F.max("batch")).scalar())
    if failed := {r["drift_type"]: r["error"] for r in found.filter("error IS NOT NULL").collect()}:
        raise ChecksFailed(failed)
    return _settle(
        found.select("deployment_id", "drift_type", "is_drift_detected", "drift_score", "confidence"), "drift_score", "confidence"
    )


# the stream must end in the state the batch fold ends in
@query("R6_streamed_alert_lifecycle", "monitoring_alerts alert_events", LIFECYCLE)
def _(t: Tables):
    out, checkpoint = _folders(t, "lifecycle")
    events = alert_events_from_lines(t.stream("lineitem"))
    _finish(lifecycle.follow_alerts(events, out, checkpoint))
    return lifecycle.followed_alerts(t.spark, out, t.alerts, events.schema["happened_at"].dataType.simpleString())


@query(
    "R7_streamed_routes",
    "",
    """SELECT o_orderkey AS id, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'notify' ELSE 'log' END AS route
    FROM orders WHERE o_orderstatus = 'O'""",
)
def _(t: Tables):
    incoming = t.stream("orders").selectExpr(
        "o_orderkey AS id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH' ELSE 'LOW' END AS severity",
        "CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' ELSE 'RESOLVED' END AS status",
    )
    out, checkpoint = _folders(t, "routes")
    _finish(jobs.route_alerts(incoming, out, checkpoint))
    return t.spark.read.parquet(out).select("id", "route")
