"""Drift of every column between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions.numeric import chi_square_p, jensen_shannon, normal_p, stability_index
from tallywatch.functions.ordered import bucket_of, previous_row, running_totals, value_bounds
from tallywatch.functions.sizes import pieces_of
from tallywatch.operators.drift_stats import ks_two_sample

SIGNIFICANCE = 0.05
JS_THRESHOLD = 0.1
DRIFT_SHARE = 0.5
SMALL, FEW_VALUES, DISTANCE, LEAST_SPREAD = 1000, 5, 0.1, 0.001  # where tests give way to distances, and the distances' limits


def split_columns(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Names of the numeric and of the categorical columns."""
    fields = [f for f in df.schema if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    categorical = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    return numeric, categorical


def _long(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """All columns as (column, value) rows, so that one job covers them."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns])
    return df.select(F.inline(pairs))


def category_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of every category on both sides, 0 where a side lacks it; NULL is a category.

    Both sides are already grouped by the join keys, so the full join adds no shuffle.
    """
    sides = []
    for name, df in (("n_ref", reference), ("n_cur", current)):
        long = _long(df, columns, "string").select("column", F.col("value").isNull().alias("is_null"), F.coalesce("value", F.lit("")).alias("value"))
        sides.append(long.groupBy("column", "is_null", "value").agg(F.count("*").alias(name)))
    joined = sides[0].join(sides[1], ["column", "is_null", "value"], "full")
    return joined.select(
        "column",
        F.when(~F.col("is_null"), F.col("value")).alias("value"),
        F.coalesce("n_ref", F.lit(0)).alias("n_ref"),
        F.coalesce("n_cur", F.lit(0)).alias("n_cur"),
    )


def categorical_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], threshold: float = JS_THRESHOLD
) -> DataFrame:
    """Jensen-Shannon distance per column, with the stability index and the chi-square statistic beside it."""
    counts = category_counts(reference, current, columns)
    total_ref = reference.select(F.count("*").cast("double")).scalar()
    total_cur = current.select(F.count("*").cast("double")).scalar()
    n_ref, n_cur = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    shares = counts.withColumns(
        {
            "p": F.coalesce(F.try_divide(n_ref, total_ref), F.lit(0.0)),
            "q": F.coalesce(F.try_divide(n_cur, total_cur), F.lit(0.0)),
            "both": n_ref + n_cur,
            "chi": F.try_divide(
                (n_ref * total_cur - n_cur * total_ref) * (n_ref * total_cur - n_cur * total_ref),
                (n_ref + n_cur) * total_ref * total_cur,
            ),
        }
    )
    found = shares.groupBy("column").agg(
        F.sqrt(F.greatest(F.lit(0.0), F.sum(jensen_shannon(F.col("p"), F.col("q"))))).alias("score"),
        F.sum(stability_index(F.col("p"), F.col("q"))).alias("stability_index"),
        F.sum("chi").alias("chi_square"),
        F.count("*").alias("categories"),
    )
    return found.select(
        "column",
        F.lit("jensen_shannon").alias("stattest"),
        "score",
        (F.col("score") >= threshold).alias("drift_detected"),
        "stability_index",
        "chi_square",
        "categories",
    )


def numeric_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], significance: float = SIGNIFICANCE,
    pieces: int | None = None,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per column over its non-NULL values.

    Values are sorted in `pieces` (default: as many as shuffle partitions), cut by the values of both sides, so that a
    column that has moved away from the reference is spread as well.
    """
    sides = [
        _long(df, columns, "double").filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
        for df in (reference, current)
    ]
    bucket = F.lit(0)
    doubles = [df.select(*[F.col(c).cast("double").alias(c) for c in columns]) for df in (reference, current)]
    pieces = pieces_of(reference.sparkSession) if pieces is None else pieces
    for name, bounds in value_bounds(doubles[0].union(doubles[1]), columns, pieces).items():
        bucket = F.when(F.col("column") == name, bucket_of(F.col("value"), bounds)).otherwise(bucket)
    found = ks_two_sample(sides[0], sides[1], [], ["column"], bucket)
    return found.select(
        "column",
        F.lit("kolmogorov_smirnov").alias("stattest"),
        F.col("p_value").alias("score"),
        (F.col("p_value") < significance).alias("drift_detected"),
        "ks_statistic",
    )


def column_drift(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None
) -> DataFrame:
    """One row per column: test, score and whether it drifted."""
    found_numeric, found_categorical = split_columns(reference)
    numeric = found_numeric if numeric is None else numeric
    categorical = found_categorical if categorical is None else categorical
    shared = ("column", "stattest", "score", "drift_detected")
    parts = []
    if numeric:
        parts.append(numeric_drift(reference, current, numeric).select(*shared))
    if categorical:
        parts.append(categorical_drift(reference, current, categorical).select(*shared))
    if not parts:
        raise ValueError("no numeric or categorical columns to compare")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def wasserstein(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], pieces: int | None = None
) -> DataFrame:
    """Wasserstein distance of each numeric column in units of the reference's spread: (column, distance, spread).

    The distance is the area between the two distribution functions: the gap between neighbouring values of both sides times
    the difference of the running shares, both found inside pieces of the values.
    """
    sides = [_long(df, columns, "double").filter(F.col("value").isNotNull() & ~F.isnan("value")) for df in (reference, current)]
    zero = F.lit(0).cast("bigint")
    points = (
        sides[0].select("column", "value", F.lit(1).cast("bigint").alias("at_ref"), zero.alias("at_cur"))
        .unionByName(sides[1].select("column", "value", zero.alias("at_ref"), F.lit(1).cast("bigint").alias("at_cur")))
        .groupBy("column", "value").agg(F.sum("at_ref").alias("at_ref"), F.sum("at_cur").alias("at_cur"))
    )
    doubles = [df.select(*[F.col(c).cast("double").alias(c) for c in columns]) for df in (reference, current)]
    bucket = F.lit(0)
    for name, bounds in value_bounds(doubles[0].union(doubles[1]), columns, pieces or pieces_of(reference.sparkSession)).items():
        bucket = F.when(F.col("column") == name, bucket_of(F.col("value"), bounds)).otherwise(bucket)
    cumulated = points.withColumns({"cum_ref": F.col("at_ref"), "cum_cur": F.col("at_cur")})
    totals = running_totals(cumulated, ["column"], [F.col("value")], ["cum_ref", "cum_cur"], bucket, with_totals=True)
    stepped = previous_row(totals, ["column"], ["value"], {"before": "value"}, bucket)

    def share_before(side: str) -> Column:
        return F.try_divide((F.col(f"cum_{side}") - F.col(f"at_{side}")).cast("double"), F.col(f"cum_{side}_total").cast("double"))

    area = F.sum(F.abs(share_before("ref") - share_before("cur")) * (F.col("value") - F.col("before")))
    spread = sides[0].groupBy("column").agg(F.stddev_pop("value").alias("spread"))
    found = stepped.groupBy("column").agg(F.coalesce(area, F.lit(0.0)).alias("_area")).join(spread, "column", "left")
    return found.select("column", (F.col("_area") / F.greatest(F.coalesce("spread", F.lit(0.0)), F.lit(LEAST_SPREAD))).alias("distance"), "spread")


def drift_by_kind(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None,
    small: int = SMALL, few_values: int = FEW_VALUES, significance: float = SIGNIFICANCE, distance: float = DISTANCE,
) -> DataFrame:
    """One row per column with the test that fits its kind and the reference's size: (column, stattest, score, drift_detected).

    Numbers with more than `few_values` distinct values: Kolmogorov-Smirnov up to `small` reference rows, the scaled
    Wasserstein distance above. Categories, and numbers of few values: up to `small` rows a test of two proportions for two
    categories and chi-square for more, the Jensen-Shannon distance above. Tests compare their p-value with `significance`,
    distances are compared with `distance`. NULL is a category of its own and no number.
    """
    found_numeric, found_categorical = split_columns(reference)
    numeric = list(found_numeric if numeric is None else numeric)
    categorical = list(found_categorical if categorical is None else categorical)
    if not numeric and not categorical:
        raise ValueError("no numeric or categorical columns to compare")
    both = [df.select(*[F.col(c).cast("double").alias(c) for c in numeric]) for df in (reference, current)]
    if numeric:
        values = _long(both[0].union(both[1]), numeric, "double").filter(F.col("value").isNotNull()).distinct()
        many = {r["column"] for r in values.groupBy("column").count().filter(F.col("count") > few_values).collect()}  # one row per column
    else:
        many = set()
    spread_out, listed = [c for c in numeric if c in many], [*categorical, *(c for c in numeric if c not in many)]
    large = reference.limit(small + 1).count() > small
    parts = []
    if spread_out and large:
        apart = wasserstein(reference, current, spread_out)
        parts.append(apart.select("column", F.lit("wasserstein").alias("stattest"), F.col("distance").alias("score"), (F.col("distance") >= distance).alias("drift_detected")))
    elif spread_out:
        parts.append(numeric_drift(reference, current, spread_out, significance).select("column", "stattest", "score", "drift_detected"))
    if listed and large:
        parts.append(categorical_drift(reference, current, listed, distance).select("column", "stattest", "score", "drift_detected"))
    elif listed:
        counted = categorical_drift(reference, current, listed)
        chi = F.coalesce("chi_square", F.lit(0.0))  # for two categories this is the square of the two-proportion z
        p = F.when(F.col("categories") == 2, normal_p(F.sqrt(chi))).otherwise(chi_square_p(chi, F.col("categories") - 1))
        name = F.when(F.col("categories") == 2, "z_test").otherwise("chi_square")
        parts.append(counted.select("column", name.alias("stattest"), p.alias("score")).withColumn("drift_detected", F.col("score") < significance))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def drift_summary(columns: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """One row: share of drifted columns, the dataset flag, and the drifted columns with score and test.

    The list has at most one entry per column of the table.
    """
    drifted = F.when(F.col("drift_detected"), F.struct(F.col("column").alias("feature"), F.col("score").alias("drift_score"), "stattest"))
    counted = columns.agg(
        F.count("*").alias("columns"),
        F.count_if("drift_detected").alias("drifted_columns"),
        F.array_sort(F.collect_list(drifted)).alias("drifted_features"),
    )
    part = F.coalesce(F.try_divide(F.col("drifted_columns").cast("double"), F.col("columns").cast("double")), F.lit(0.0))
    return counted.withColumn("drift_share", part).withColumn("dataset_drift", part >= share)
