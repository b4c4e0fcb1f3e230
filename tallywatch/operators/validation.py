"""Row checks: request texts, batches, feedback, table constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.text import (
    MAX_BATCH,
    MAX_COMMENT_LENGTH,
    MAX_TEXT_LENGTH,
    MIN_BATCH,
    MIN_TEXT_LENGTH,
    strip,
)
from tallywatch.schemas import LABELS, SENTIMENTS


def text_reason(text: Column) -> Column:
    """Why a request text is rejected, NULL when it is fine; the length is taken before stripping."""
    return (
        F.when(text.isNull(), "missing")
        .when(F.length(text) < MIN_TEXT_LENGTH, "too_short")
        .when(F.length(text) > MAX_TEXT_LENGTH, "too_long")
        .when(F.length(strip(text)) == 0, "blank")
    )


def validate_texts(df: DataFrame, column: str = "text") -> DataFrame:
    """Add `reason` and, for accepted texts, `clean_text`."""
    reason = text_reason(F.col(column))
    return df.withColumn("reason", reason).withColumn(
        "clean_text", F.when(F.col("reason").isNull(), strip(F.col(column)))
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull())


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull())


def validate_batches(df: DataFrame, column: str = "texts") -> DataFrame:
    """Add `reason` and, for accepted batches, `clean_texts`."""
    size = F.size(column)
    blank = F.exists(column, lambda text: F.coalesce(F.length(strip(text)), F.lit(0)) == 0)
    reason = F.when(size < MIN_BATCH, "too_few").when(size > MAX_BATCH, "too_many").when(blank, "blank_item")
    return df.withColumn("reason", reason).withColumn(
        "clean_texts", F.when(F.col("reason").isNull(), F.transform(column, strip))
    )


def batch_items(df: DataFrame) -> DataFrame:
    """One row per text of a batch with its own request id and an equal share of the batch's time."""
    each = F.col("total_time_ms") / F.size("texts")
    return df.select(
        F.col("request_id").alias("batch_id"), each.alias("prediction_time_ms"), F.posexplode("texts").alias("item", "text")
    ).withColumn("request_id", F.concat_ws("_", "batch_id", "item"))


def validate_feedback(df: DataFrame) -> DataFrame:
    """Add `reason`: a score outside 0..1 or a comment that is too long."""
    score = F.col("feedback_score")
    return df.withColumn(
        "reason",
        F.when(F.col("prediction_id").isNull(), "missing_prediction")
        .when(F.col("is_correct").isNull(), "missing_is_correct")
        .when((score < 0) | (score > 1), "score_out_of_range")
        .when(F.length("comments") > MAX_COMMENT_LENGTH, "comment_too_long"),
    )


def _outside(column: str, allowed: tuple) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*allowed)


# Rules of the prediction log: name -> condition of a violating row.
def prediction_rules() -> dict[str, Column]:
    confidence = F.col("confidence_score")
    return {
        "deployment_id_missing": F.col("deployment_id").isNull(),
        "request_id_missing": F.col("request_id").isNull(),
        "confidence_out_of_range": (confidence < 0) | (confidence > 1),
        "label_not_allowed": _outside("predicted_label", LABELS),
        "sentiment_not_allowed": _outside("predicted_sentiment", SENTIMENTS),
        "prediction_time_missing": F.col("prediction_time").isNull(),
    }


def violations(df: DataFrame, rules: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """Violating rows per rule, all rules counted in one pass: columns keys, `rule`, `violations`."""
    keys = keys or []
    counted = df.groupBy(*keys).agg(*[F.count_if(condition).alias(name) for name, condition in rules.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return counted.select(*keys, F.inline(rows))
