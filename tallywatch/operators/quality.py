"""Completeness, consistency and validity of encoded datasets, for all splits in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.numeric import share
from tallywatch.schemas import LABELS

KEY_COLUMNS = ("input_ids", "attention_mask", "label")
MIN_COMPLETENESS = 0.95
INCONSISTENT_SCORE, INVALID_SCORE = 0.8, 0.7


def quality_counts(df: DataFrame, expected: Sequence[int] = LABELS) -> DataFrame:
    """Per split: rows, missing values per key column, rows with unequal lengths, rows with unexpected labels.

    A NULL label is missing and also unexpected.
    """
    present = [c for c in KEY_COLUMNS if c in df.columns]
    zero = F.lit(0).cast("bigint")
    lengths = (
        F.count_if(F.size("input_ids") != F.size("attention_mask"))
        if {"input_ids", "attention_mask"} <= set(present)
        else zero
    )
    unexpected = F.count_if(~F.coalesce(F.col("label").isin(*expected), F.lit(False))) if "label" in present else zero
    return df.groupBy("split").agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in present],
        lengths.alias("unequal_lengths"),
        unexpected.alias("unexpected_labels"),
        F.lit(len(present)).alias("key_columns"),
    )


def quality_checks(df: DataFrame, expected: Sequence[int] = LABELS) -> DataFrame:
    """One row per split and check: `score` and whether it passed."""
    counts = quality_counts(df, expected)
    missing = [F.col(c) for c in counts.columns if c.startswith("missing_")]
    total_missing = sum(missing[1:], missing[0]) if missing else F.lit(0)
    complete = F.coalesce(1 - share(total_missing, F.col("rows") * F.col("key_columns")), F.lit(0.0))
    consistent = F.col("unequal_lengths") == 0
    valid = F.col("unexpected_labels") == 0
    checks = F.array(
        F.struct(F.lit("completeness").alias("check"), complete.alias("score"),
                 (complete > MIN_COMPLETENESS).alias("passed"), total_missing.cast("bigint").alias("problems")),
        F.struct(F.lit("consistency").alias("check"), F.when(consistent, 1.0).otherwise(INCONSISTENT_SCORE).alias("score"),
                 consistent.alias("passed"), F.col("unequal_lengths").alias("problems")),
        F.struct(F.lit("validity").alias("check"), F.when(valid, 1.0).otherwise(INVALID_SCORE).alias("score"),
                 valid.alias("passed"), F.col("unexpected_labels").alias("problems")),
    )
    return counts.select("split", F.inline(checks))


def quality_report(df: DataFrame, expected: Sequence[int] = LABELS) -> DataFrame:
    """Passed checks, all checks and their ratio per split and overall (`level` 1)."""
    checks = quality_checks(df, expected)
    return checks.rollup("split").agg(
        F.count_if("passed").alias("passed_checks"),
        F.count("*").alias("total_checks"),
        share(F.count_if("passed"), F.count("*")).alias("quality_score"),
        F.grouping_id().cast("bigint").alias("level"),
    )


def unexpected_labels(df: DataFrame, expected: Sequence[int] = LABELS) -> DataFrame:
    """The labels observed in each split that are not expected."""
    observed = df.select("split", "label").distinct()
    return observed.filter(~F.coalesce(F.col("label").isin(*expected), F.lit(False)))
