"""Histograms, rates and quantiles over time windows."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.numeric import share
from tallywatch.functions.ordered import bucket_of, exact_quantiles, value_bounds
from tallywatch.functions.sizes import pieces_of

# Upper bounds of the histogram buckets; +Inf is added.
DURATION_BOUNDS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
CONFIDENCE_BOUNDS = (0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.95, 0.99, 1.0)
DEFAULT_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)

QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _bucket_counts(value: Column, bounds: Sequence[float]) -> Column:
    """Cumulative counts per bound as one array: a fixed number of conditional counts, no row expansion."""
    return F.array(*[F.count_if(value <= F.lit(float(b))) for b in bounds], F.count(value))


def histogram(df: DataFrame, labels: Sequence[Column | str], value: Column, bounds: Sequence[float]) -> DataFrame:
    """Cumulative histogram per label set: one row per bucket (`le`), with the sum and count of the whole set."""
    counted = df.groupBy(*labels).agg(
        _bucket_counts(value, bounds).alias("_counts"), F.sum(value).alias("value_sum"), F.count(value).alias("value_count")
    )
    names = [str(float(b)) for b in bounds] + ["+Inf"]
    label_names = [c for c in counted.columns if c not in ("_counts", "value_sum", "value_count")]
    rows = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("le"), F.col("_counts").alias("bucket_count"))
    return counted.select(*label_names, "value_sum", "value_count", F.inline(rows).alias("le", "bucket_count"))


def histogram_quantile(counts: Column, bounds: Sequence[float], q: float) -> Column:
    """Quantile from cumulative counts, linear inside its bucket; beyond the last bound, that bound."""
    edges = F.array(F.lit(0.0), *[F.lit(float(b)) for b in bounds])
    below = F.concat(F.array(F.lit(0).cast("bigint")), counts)
    total = F.element_at(counts, -1)
    rank = F.lit(float(q)) * total
    slot = F.array_position(F.transform(counts, lambda c: c >= rank), True).cast("int")
    low, high = F.element_at(edges, slot), F.get(edges, slot)
    under, upto = F.element_at(below, slot), F.get(below, slot)
    inside = low + (high - low) * (rank - under) / (upto - under)
    return F.when(total == 0, F.lit(None).cast("double")).when(slot > len(bounds), float(bounds[-1])).otherwise(inside)


def window_quantiles(
    df: DataFrame, ts: str, labels: Sequence[str], value: Column, bounds: Sequence[float] = DURATION_BOUNDS,
    quantiles: dict[str, float] = QUANTILES, width: str = "5 minutes",
) -> DataFrame:
    """Histogram quantiles per window and label set."""
    counted = df.groupBy(F.window(ts, width).alias("w"), *labels).agg(_bucket_counts(value, bounds).alias("_counts"))
    return counted.select(
        F.col("w.start").alias("window_start"),
        *labels,
        *[histogram_quantile(F.col("_counts"), bounds, q).alias(name) for name, q in quantiles.items()],
    )


def exact_window_quantiles(
    df: DataFrame, ts: str, labels: Sequence[str], value: Column, quantiles: dict[str, float] = QUANTILES,
    width: str = "1 day", pieces: int | None = None,
) -> DataFrame:
    """Interpolated exact quantiles per window and label set, from the counts of distinct values."""
    counts = (
        df.select(F.window(ts, width)["start"].alias("window_start"), *labels, value.alias("_value"))
        .filter(F.col("_value").isNotNull())
        .groupBy("window_start", *labels, "_value")
        .agg(F.count("*").alias("_n"))
    )
    pieces = pieces_of(df.sparkSession) if pieces is None else pieces
    bounds = value_bounds(df.select(value.alias("_value")), ["_value"], pieces)["_value"]
    return exact_quantiles(counts, ["window_start", *labels], "_value", "_n", quantiles, bucket_of(F.col("_value"), bounds))


def approximate_window_quantiles(
    df: DataFrame, ts: str, labels: Sequence[str], value: Column, quantiles: dict[str, float] = QUANTILES,
    width: str = "5 minutes", accuracy: int = 10_000,
) -> DataFrame:
    """Sketch-based quantiles per window and label set, for windows too wide to count every value."""
    picked = F.percentile_approx(value, [float(q) for q in quantiles.values()], accuracy)
    found = df.groupBy(F.window(ts, width).alias("w"), *labels).agg(picked.alias("_q"))
    return found.select(
        F.col("w.start").alias("window_start"),
        *labels,
        *[F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(quantiles)],
    )


def rates(
    df: DataFrame, ts: str, labels: Sequence[str] = (), seconds: int = 300, slide_seconds: int | None = None, per: float = 1.0
) -> DataFrame:
    """Events per `per` seconds in every window.

    Sliding windows are sums of panes: events are counted once per pane as wide as the slide divides both, and only the
    counts are spread over the windows.
    """
    width, slide = f"{seconds} seconds", f"{slide_seconds or seconds} seconds"
    pane = f"{gcd(seconds, slide_seconds or seconds)} seconds"
    panes = df.groupBy(F.window(ts, pane)["start"].alias("_pane"), *labels).agg(F.count("*").alias("_n"))
    counted = panes.groupBy(F.window("_pane", width, slide).alias("w"), *labels).agg(F.sum("_n").alias("events"))
    return counted.select(
        F.col("w.start").alias("window_start"),
        *labels,
        "events",
        (F.col("events") * F.lit(float(per)) / F.lit(float(seconds))).alias("rate"),
    )


def window_means(df: DataFrame, ts: str, value: str, labels: Sequence[str] = (), width: str = "5 minutes") -> DataFrame:
    """Mean value per window and label set."""
    grouped = df.groupBy(F.window(ts, width).alias("w"), *labels)
    return grouped.agg(F.avg(value).alias("mean"), F.count(value).alias("n")).select(
        F.col("w.start").alias("window_start"), *labels, "mean", "n"
    )


def error_rates(df: DataFrame, ts: str, labels: Sequence[str] = (), seconds: int = 300) -> DataFrame:
    """Errors per minute and share of errors per window."""
    errors = F.count_if("is_error")
    counted = df.groupBy(F.window(ts, f"{seconds} seconds").alias("w"), *labels).agg(
        (errors * F.lit(60.0) / F.lit(float(seconds))).alias("errors_per_minute"),
        share(errors, F.count("*")).alias("error_ratio"),
    )
    return counted.select(F.col("w.start").alias("window_start"), *labels, "errors_per_minute", "error_ratio")
