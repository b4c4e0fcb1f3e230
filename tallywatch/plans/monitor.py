"""The drift monitor: all checks for all deployments, as uniform result rows."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.operators.alerts import drift_alerts
from tallywatch.operators.drift_stats import concept_drift, model_drift
from tallywatch.operators.drift_text import TextReference
from tallywatch.operators.filters import since
from tallywatch.sources.tables import append_rows

MIN_ROWS = 10
RESULT = (
    "deployment_id string, drift_type string, is_drift_detected boolean, drift_score double, confidence double, "
    "details string, error string"
)

log = logging.getLogger(__name__)


class ChecksFailed(RuntimeError):
    """Checks that failed, by name; `results` are the rows of the others, if there are any."""

    def __init__(self, errors: dict[str, object], results: DataFrame | None = None):
        super().__init__("; ".join(f"drift check {name} failed: {error}" for name, error in errors.items()))
        self.errors, self.results = errors, results


def result_rows(df: DataFrame, drift_type: str, confidence: Column) -> DataFrame:
    known = ("deployment_id", "is_drift_detected", "drift_score")
    details = F.to_json(F.struct(*[c for c in df.columns if c not in known]))
    return df.select(
        "deployment_id",
        F.lit(drift_type).alias("drift_type"),
        "is_drift_detected",
        "drift_score",
        confidence.alias("confidence"),
        details.alias("details"),
        F.lit(None).cast("string").alias("error"),
    )


def failure(spark: SparkSession, drift_type: str, error: Exception) -> DataFrame:
    """The result row of a check that failed: no deployment, no verdict, the whole message."""
    return spark.createDataFrame([(None, drift_type, None, None, None, None, str(error))], RESULT)


def drift_checks(
    reference: TextReference, logs: DataFrame, as_of: str, with_texts: Callable[[DataFrame], DataFrame] = lambda logs: logs,
    hours: int = 24, days: int = 7, min_rows: int = MIN_ROWS,
) -> dict[str, Callable[[], DataFrame]]:
    """Each check as a function building its result rows; deployments with fewer recent rows than `min_rows` have none.

    `with_texts` adds `input_text` to log rows that do not carry it.
    """
    recent = since(logs, "predicted_at", as_of, hours=hours)
    busy = recent.groupBy("deployment_id").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_rows).select("deployment_id")

    def scoped(df: DataFrame) -> DataFrame:
        return df.join(busy, "deployment_id", "left_semi")

    return {
        "data": lambda: result_rows(
            reference.data_drift(with_texts(scoped(recent))), "data", F.col("confidence")
        ),
        "concept": lambda: result_rows(scoped(concept_drift(recent)), "concept", F.col("drift_score")),
        "model": lambda: result_rows(scoped(model_drift(logs, as_of, days)), "model", F.col("confidence")),
    }


def run_monitor(*args, **kwargs) -> DataFrame:
    """All checks in one frame. Where a check's plan cannot be built, the others are still, and `ChecksFailed` is raised with them."""
    results, errors = None, {}
    for name, build in drift_checks(*args, **kwargs).items():
        try:
            part = build()
        except Exception as error:
            log.exception("drift check %s failed", name)
            errors[name] = error
            continue
        results = part if results is None else results.unionByName(part)
    if errors:
        raise ChecksFailed(errors, results) from next(iter(errors.values()))
    return results


def report_rows(results: DataFrame) -> DataFrame:
    """Result rows as rows of the drift reports: everything but type, verdict and score is JSON."""
    data = F.to_json(F.struct("deployment_id", "confidence", "details", "error"), {"ignoreNullFields": "false"})
    return results.select(
        F.pmod(F.xxhash64("deployment_id", "drift_type", "details", "error"), F.lit(2**31 - 1)).cast("int").alias("id"),
        F.col("drift_type").alias("report_type"),
        F.col("is_drift_detected").alias("drift_detected"),
        "drift_score",
        data.alias("report_data"),
    )


def write_monitor(path: str, *args, **kwargs) -> list[str]:
    """Append every check's rows to the drift reports on its own, so one failing job does not stop the others.

    A check that failed leaves a row with its error; the names of those are returned.
    """
    failed = []
    for name, build in drift_checks(*args, **kwargs).items():
        try:
            append_rows(report_rows(build()), "drift_reports", path)
        except Exception as error:
            log.exception("drift check %s failed", name)
            append_rows(report_rows(failure(SparkSession.active(), name, error)), "drift_reports", path)
            failed.append(name)
    return failed


def monitor_alerts(results: DataFrame) -> DataFrame:
    """Alerts for the drifts found."""
    return drift_alerts(results.drop("error"))
