"""Experiment runs: summaries, rankings, updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.ordered import previous_row

# Metrics a run can be ranked by.
RUN_METRICS = ("accuracy", "f1_score", "precision", "recall", "loss", "training_duration")


def experiment_summary(runs: DataFrame) -> DataFrame:
    """Per experiment: run count, best and mean metrics over non-NULL values, last run date."""
    return runs.groupBy("experiment_name").agg(
        F.count("*").alias("run_count"),
        F.max("accuracy").alias("best_accuracy"),
        F.avg("accuracy").alias("avg_accuracy"),
        F.max("f1_score").alias("best_f1_score"),
        F.avg("f1_score").alias("avg_f1_score"),
        F.avg("training_duration").alias("avg_training_duration"),
        F.max("created_at").alias("last_run_date"),
    )


def _ranked(runs: DataFrame, metric: str) -> DataFrame:
    if metric not in RUN_METRICS or metric not in runs.columns:
        raise ValueError(f"runs have no metric {metric!r}")
    return runs.filter(F.col(metric).isNotNull())


def best_runs(runs: DataFrame, metric: str = "f1_score", limit: int = 10, experiment: str | None = None) -> DataFrame:
    """The runs with the highest metric; the id settles ties."""
    if experiment is not None:
        runs = runs.filter(F.col("experiment_name") == experiment)
    return _ranked(runs, metric).orderBy(F.col(metric).desc(), F.col("id")).limit(limit)


def best_runs_per_experiment(runs: DataFrame, metric: str = "f1_score", limit: int = 10) -> DataFrame:
    """The same inside every experiment; each task keeps only its own best `limit` rows before the shuffle."""
    order = Window.partitionBy("experiment_name").orderBy(F.col(metric).desc(), F.col("id"))
    ranked = _ranked(runs, metric).withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.filter(F.col("rank") <= limit)


def best_checkpoint(
    checkpoints: DataFrame, keys: Sequence[str], metric: str = "eval_f1", highest: bool = True,
    tie: Sequence[str] = ("epoch",),
) -> DataFrame:
    """The checkpoint with the best metric per key; the earliest on ties."""
    others = [c for c in checkpoints.columns if c not in keys]
    better = F.col(metric) if highest else -F.col(metric)
    rank = F.struct(better, *[-F.col(c) for c in tie])
    best = checkpoints.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("best"))
    return best.select(*keys, "best.*")


def metric_changes(runs: DataFrame, metric: str = "f1_score") -> DataFrame:
    """Each run's metric with the run before it in the same experiment, by creation time."""
    rows = runs.select("experiment_name", "created_at", "id", metric)
    day = F.to_date("created_at")
    with_previous = previous_row(rows, ["experiment_name"], ["created_at", "id"], {"previous": metric}, day)
    return with_previous.withColumn("change", F.col(metric) - F.col("previous"))


def runs_of_deployments(deployments: DataFrame, runs: DataFrame) -> DataFrame:
    """Every deployment with the run it serves, if that run is known."""
    known = runs.select(F.col("id").alias("experiment_run_id"), "experiment_name", "run_name", "f1_score")
    return deployments.join(known, "experiment_run_id", "left")
