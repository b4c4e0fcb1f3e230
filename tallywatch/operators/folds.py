"""Latest state from append-only change logs.

Every fold is an aggregate that combines before the shuffle, so an entity with very many changes never has them
collected or sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Run fields an update may set, with their types.
RUN_FIELDS = {
    "status": "string",
    "accuracy": "double",
    "f1_score": "double",
    "precision": "double",
    "recall": "double",
    "loss": "double",
    "training_duration": "double",
}


def fold_run_updates(changes: DataFrame, fields: dict[str, str] = RUN_FIELDS) -> DataFrame:
    """Last value set per field and run, an explicit NULL included; fields a run does not have are ignored.

    `changes`: run_id, seq, field, value (text), changed_at. `<field>_set` tells whether the field was set at all.
    """
    folded = []
    for name, kind in fields.items():
        when = F.when(F.col("field") == name, F.col("seq"))
        folded.append(F.max_by("value", when).cast(kind).alias(name))
        folded.append((F.count_if(F.col("field") == name) > 0).alias(f"{name}_set"))
    return changes.groupBy("run_id").agg(*folded, F.max_by("changed_at", "seq").alias("updated_at"))


def apply_run_updates(runs: DataFrame, changes: DataFrame, fields: dict[str, str] = RUN_FIELDS) -> DataFrame:
    """The runs with their updates applied."""
    present = {name: kind for name, kind in fields.items() if name in runs.columns}
    latest = fold_run_updates(changes, present)
    renamed = latest.select("run_id", *[F.col(c).alias(f"new_{c}") for c in latest.columns if c != "run_id"])
    joined = runs.join(renamed, runs.id == renamed.run_id, "left")
    updated = {
        name: F.when(F.coalesce(F.col(f"new_{name}_set"), F.lit(False)), F.col(f"new_{name}")).otherwise(F.col(name))
        for name in present
    }
    return joined.withColumns(updated).withColumn("updated_at", F.col("new_updated_at")).select(
        *runs.columns, *([] if "updated_at" in runs.columns else ["updated_at"])
    )


def _last_given(column: str, given: Column | None = None) -> Column:
    given = F.col(column).isNotNull() if given is None else given
    return F.max_by(column, F.when(given, F.col("seq"))).alias(column)


def fold_deployment_updates(changes: DataFrame) -> DataFrame:
    """Latest status, health and metrics per deployment; arguments that were not given overwrite nothing.

    `changes`: deployment_id, seq, status, health_status, request_count, avg_response_time, error_rate, changed_at.
    A status update also moves the last health check, a metrics update the update time.
    """
    metrics = ("request_count", "avg_response_time", "error_rate")
    has_metrics = F.coalesce(*[F.col(m).cast("double") for m in metrics]).isNotNull()
    return changes.groupBy("deployment_id").agg(
        _last_given("status"),
        _last_given("health_status", F.coalesce(F.col("health_status"), F.lit("")) != ""),
        *[_last_given(m) for m in metrics],
        F.max_by("changed_at", F.when(F.col("status").isNotNull(), F.col("seq"))).alias("last_health_check"),
        F.max_by("changed_at", F.when(has_metrics, F.col("seq"))).alias("updated_at"),
    )


ALERT_STATE = "status", "acknowledged_at", "resolved_at", "resolved_by", "resolution_notes"


def fold_alert_events(events: DataFrame) -> DataFrame:
    """What the actions on each alert add up to, before the alert's own first status is known.

    `events`: alert_id, seq, action (acknowledge or resolve), actor, notes, happened_at. Only the first acknowledge can
    matter, and only when nothing resolved the alert before it; the last resolve wins; notes stay unless given anew.
    """
    is_ack, is_resolve = F.col("action") == "acknowledge", F.col("action") == "resolve"
    ack_seq, resolve_seq = F.when(is_ack, F.col("seq")), F.when(is_resolve, F.col("seq"))
    noted = F.when(is_resolve & (F.coalesce(F.col("notes"), F.lit("")) != ""), F.col("seq"))
    return events.groupBy("alert_id").agg(
        F.min(ack_seq).alias("first_ack"),
        F.min(resolve_seq).alias("first_resolve"),
        F.min_by("actor", ack_seq).alias("ack_actor"),
        F.min_by("happened_at", ack_seq).alias("ack_at"),
        F.max_by("actor", resolve_seq).alias("resolve_actor"),
        F.max_by("happened_at", resolve_seq).alias("resolve_at"),
        F.max_by("notes", noted).alias("resolve_notes"),
    )


def alert_state(folded: DataFrame, first_status: Column) -> DataFrame:
    """Columns of the final alert state from the folded actions and the status the alert started with."""
    resolved = F.col("first_resolve").isNotNull()
    acknowledged = (
        (first_status == "ACTIVE")
        & F.col("first_ack").isNotNull()
        & (~resolved | (F.col("first_ack") < F.col("first_resolve")))
    )
    ack_note = F.when(acknowledged, F.concat(F.lit("Acknowledged by: "), F.col("ack_actor")))
    return folded.withColumns(
        {
            "status": F.when(resolved, "RESOLVED").when(acknowledged, "ACKNOWLEDGED").otherwise(first_status),
            "acknowledged_at": F.when(acknowledged, F.col("ack_at")),
            "resolved_at": F.col("resolve_at"),
            "resolved_by": F.col("resolve_actor"),
            "resolution_notes": F.coalesce(F.col("resolve_notes"), ack_note),
        }
    )


def alert_lifecycle(alerts: DataFrame, events: DataFrame) -> DataFrame:
    """Every alert with its state after all actions on it."""
    started = alerts.select(F.col("id").alias("alert_id"), F.col("status").alias("first_status"))
    folded = started.join(fold_alert_events(events), "alert_id", "left")
    return alert_state(folded, F.col("first_status")).select("alert_id", "first_status", *ALERT_STATE)
