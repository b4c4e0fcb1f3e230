"""Two-sample distances, concept drift and trends."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.numeric import kolmogorov_p, kolmogorov_small_p, share, student_t_p
from tallywatch.functions.ordered import running_totals
from tallywatch.operators.filters import since
from tallywatch.operators.usage import LOW_CONFIDENCE, daily_performance


def value_counts(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Rows per key and distinct value, NULL values left out: columns keys, `value`, `n`.

    NULLs are dropped by their count of 0, after the grouping; a filter on the value would be computed a second time.
    """
    counted = df.groupBy(*keys, value.alias("value")).agg(F.count(value).alias("n"))
    return counted.filter(F.col("n") > 0)


def magnitude_bucket(value: Column) -> Column:
    """A bucket per power of two, enough to spread whole numbers such as lengths."""
    return F.floor(F.log2(F.greatest(value, F.lit(0)) + 1))


def ks_two_sample(
    reference: DataFrame, current: DataFrame, keys: Sequence[str], shared: Sequence[str] = (), bucket: Column | None = None,
    exact_cells: int = 0,
) -> DataFrame:
    """Kolmogorov-Smirnov distance and p-value of every key of `current` against the reference.

    Both sides hold one row per distinct value (`value`, `n`); `shared` are keys of both sides, `keys` of the current
    side only. The distance is reached at a current value or just below one, so the reference's running totals are
    joined to the current values by equality and the reference is never repeated per key. The p-value is the limiting series;
    where the product of the sizes is at most `exact_cells`, the exact one.
    """
    bucket = magnitude_bucket(F.col("value")) if bucket is None else bucket
    shared, keys = list(shared), list(keys)
    points = reference.select(*shared, "value", F.col("n").alias("n_ref")).unionByName(
        current.select(*shared, "value").distinct().withColumn("n_ref", F.lit(0).cast("bigint"))
    )
    at_point = points.groupBy(*shared, "value").agg(F.sum("n_ref").alias("at_ref")).withColumn("cum_ref", F.col("at_ref"))
    ref = running_totals(at_point, shared, [F.col("value")], ["cum_ref"], bucket, with_totals=True)
    cur = running_totals(
        current.select(*keys, *shared, "value", F.col("n").alias("at_cur"), F.col("n").alias("cum_cur")),
        [*keys, *shared], [F.col("value")], ["cum_cur"], bucket, with_totals=True,
    )
    joined = cur.join(ref, [*shared, "value"])
    n_ref, n_cur = F.col("cum_ref_total").cast("double"), F.col("cum_cur_total").cast("double")
    at = F.abs(F.try_divide(F.col("cum_ref").cast("double"), n_ref) - F.col("cum_cur") / n_cur)
    below = F.abs(
        F.try_divide((F.col("cum_ref") - F.col("at_ref")).cast("double"), n_ref) - (F.col("cum_cur") - F.col("at_cur")) / n_cur
    )
    found = joined.groupBy(*keys, *shared).agg(
        F.max(F.greatest(at, below)).alias("ks_statistic"),
        F.max("cum_ref_total").alias("n_ref"),
        F.max("cum_cur_total").alias("n_cur"),
    )
    sides = F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")
    return found.withColumn("p_value", kolmogorov_small_p(*sides, exact_cells) if exact_cells else kolmogorov_p(*sides))


@dataclass(frozen=True)
class ConceptThresholds:
    """When each concept-drift flag is raised; the defaults flag an evenly split stream as unusual."""

    low_mean: float = 0.7
    high_std: float = 0.3
    low_share: float = 0.3
    min_entropy: float = 0.5
    max_entropy: float = 0.95
    score: float = 0.1


def concept_drift(
    logs: DataFrame, keys: Sequence[str] = ("deployment_id",), limits: ConceptThresholds = ConceptThresholds()
) -> DataFrame:
    """Confidence mean, population deviation, low share and sentiment entropy per key, the four flags and the score.

    Rows are aggregated once per (key, sentiment); means and deviations are merged from there.
    """
    return concept_of(confidence_parts(logs, keys), keys, limits)


def confidence_parts(logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts and confidence moments per key and sentiment."""
    return logs.groupBy(*keys, "predicted_sentiment").agg(
        F.count("*").cast("double").alias("n"),
        F.count("confidence_score").cast("double").alias("c"),
        F.avg("confidence_score").alias("mean"),
        F.var_pop("confidence_score").alias("var"),
        F.count_if(F.col("confidence_score") < LOW_CONFIDENCE).cast("double").alias("low"),
    )


def merged_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Confidence parts of several sets of rows as those of all rows: one per key and sentiment."""
    second = F.sum(F.col("c") * (F.col("var") + F.col("mean") * F.col("mean")))
    found = parts.groupBy(*keys, "predicted_sentiment").agg(
        F.sum("n").alias("n"), F.sum("c").alias("c"), F.try_divide(F.sum(F.col("c") * F.col("mean")), F.sum("c")).alias("mean"),
        F.try_divide(second, F.sum("c")).alias("_second"), F.sum("low").alias("low"),
    )
    var = F.greatest(F.lit(0.0), F.col("_second") - F.col("mean") * F.col("mean"))
    return found.withColumn("var", F.when(F.col("_second").isNotNull(), var)).drop("_second")


def concept_of(parts: DataFrame, keys: Sequence[str], limits: ConceptThresholds = ConceptThresholds()) -> DataFrame:
    """Concept drift from one row of confidence parts per key and sentiment."""
    n, c, mean = F.sum("n"), F.sum("c"), F.sum(F.col("c") * F.col("mean")) / F.sum("c")
    merged = parts.groupBy(*keys).agg(
        n.cast("bigint").alias("predictions"),
        mean.alias("avg_confidence"),
        (F.sum(F.col("c") * (F.col("var") + F.col("mean") * F.col("mean"))) / c).alias("_second"),
        share(F.sum("low"), n).alias("low_confidence_ratio"),
        F.greatest(F.lit(0.0), F.log2(n) - F.sum(F.col("n") * F.log2("n")) / n).alias("prediction_entropy"),
    )
    variance = F.greatest(F.lit(0.0), F.col("_second") - F.col("avg_confidence") * F.col("avg_confidence"))
    flagged = merged.withColumn("confidence_std", F.sqrt(variance)).withColumns(
        {
            "low_avg_confidence": F.col("avg_confidence") < limits.low_mean,
            "high_confidence_variance": F.col("confidence_std") > limits.high_std,
            "high_low_confidence_ratio": F.col("low_confidence_ratio") > limits.low_share,
            "unusual_prediction_entropy": (F.col("prediction_entropy") < limits.min_entropy)
            | (F.col("prediction_entropy") > limits.max_entropy),
        }
    )
    flags = ("low_avg_confidence", "high_confidence_variance", "high_low_confidence_ratio", "unusual_prediction_entropy")
    score = sum((F.coalesce(F.col(f), F.lit(False)).cast("int") for f in flags), F.lit(0)) / F.lit(4.0)
    return flagged.withColumn("drift_score", score).withColumn(
        "is_drift_detected", F.col("drift_score") > limits.score
    ).drop("_second")


def day_index(daily: DataFrame, keys: Sequence[str], date: str = "prediction_date") -> DataFrame:
    """Number the days of each key from 0 in date order; days without rows take no number."""
    order = Window.partitionBy(*keys).orderBy(date)
    return daily.withColumn("day_index", (F.row_number().over(order) - 1).cast("double"))


def correlation(y: str, x: str) -> Column:
    """Correlation over the pairs without NULL; NULL for a constant series, on which `corr` fails in ANSI mode."""
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x)))


def linear_trend(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares slope, intercept, correlation and two-sided p-value per key.

    A constant series has slope and correlation 0 and p-value 1.
    """
    fitted = df.groupBy(*keys).agg(
        F.count(y).alias("points"),
        F.regr_slope(y, x).alias("_slope"),
        F.avg(y).alias("_mean"),
        F.regr_intercept(y, x).alias("_intercept"),
        correlation(y, x).alias("_r"),
    )
    flat = F.col("_r").isNull()
    r = F.when(flat, 0.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_r"))))
    return fitted.select(
        *keys,
        "points",
        F.when(flat, 0.0).otherwise(F.col("_slope")).alias("slope"),
        F.when(flat, F.col("_mean")).otherwise(F.col("_intercept")).alias("intercept"),
        r.alias("r_value"),
        F.when(flat, 1.0).otherwise(student_t_p(r, F.col("points"))).alias("p_value"),
    )


def model_drift(
    logs: DataFrame, as_of: str, days: int = 7, threshold: float = 0.05, significance: float = 0.05, min_days: int = 3
) -> DataFrame:
    """Declining confidence or growing latency per deployment over the daily means of the lookback."""
    daily = daily_performance(since(logs, "predicted_at", as_of, days=days), ["deployment_id"])
    return trend_of(daily, threshold, significance, min_days)


def trend_of(daily: DataFrame, threshold: float = 0.05, significance: float = 0.05, min_days: int = 3) -> DataFrame:
    """Model drift from the means of each deployment's days."""
    keys = ["deployment_id"]
    daily = day_index(daily, keys)
    # one pass fits both series: days with a NULL or 0 time void the time trend of the deployment
    timed = F.coalesce(F.col("avg_prediction_time"), F.lit(0.0)) != 0
    both = F.array(
        F.struct(F.lit("confidence").alias("series"), F.col("avg_confidence").alias("y"), F.lit(True).alias("usable")),
        F.struct(F.lit("time").alias("series"), F.col("avg_prediction_time").alias("y"), timed.alias("usable")),
    )
    long = daily.select(*keys, "day_index", F.inline(both))
    usable = long.groupBy(*keys, "series").agg(F.bool_and("usable").alias("usable"))
    trends = linear_trend(long, [*keys, "series"], "day_index", "y").join(usable, [*keys, "series"])
    picked = {s: F.max(F.when(F.col("series") == s, F.struct("slope", "r_value", "p_value", "usable", "points"))) for s in ("confidence", "time")}
    wide = trends.groupBy(*keys).agg(picked["confidence"].alias("c"), picked["time"].alias("t"))
    enough = F.col("c.points") >= min_days
    has_time = enough & F.col("t.usable")
    time_slope = F.when(has_time, F.col("t.slope"))
    time_p = F.when(has_time, F.col("t.p_value"))
    declining = (F.col("c.slope") < -threshold) & (F.col("c.p_value") < significance)
    degrading = F.coalesce((time_slope > threshold * 1000) & (time_p < significance), F.lit(False))
    score = F.when(declining, F.abs("c.slope")).otherwise(F.abs(F.coalesce(time_slope, F.lit(0.0))) / 1000)
    best_p = F.least(F.col("c.p_value"), F.coalesce(time_p, F.lit(1.0)))
    return wide.select(
        *keys,
        F.col("c.points").alias("data_points"),
        F.when(enough, F.col("c.slope")).alias("confidence_slope"),
        F.when(enough, F.col("c.r_value")).alias("confidence_r"),
        F.when(enough, F.col("c.p_value")).alias("confidence_p"),
        time_slope.alias("time_slope"),
        F.when(has_time, F.col("t.r_value")).alias("time_r"),
        time_p.alias("time_p"),
        F.when(enough, declining).alias("confidence_declining"),
        F.when(enough, degrading).alias("performance_degrading"),
        F.coalesce(enough & (declining | degrading), F.lit(False)).alias("is_drift_detected"),
        F.when(enough, score).otherwise(0.0).alias("drift_score"),
        F.when(enough, 1.0 - best_p).otherwise(0.0).alias("confidence"),
        F.when(~enough, "Insufficient data").alias("error"),
    )
