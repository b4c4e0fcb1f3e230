"""Stored sketches: quantiles and distinct clients of any window from panes that are merged, not from rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.operators.series import QUANTILES

RANK_ERROR = 0.02  # of a quantile at the default size, with ample room; the sketch's own bound is below 0.01
COUNT_ERROR = 0.05


def sketch_panes(
    df: DataFrame, ts: str, labels: Sequence[str], value: Column, client: Column | None = None, pane: str = "5 minutes", size: int = 400
) -> DataFrame:
    """One row per pane and label set: rows with a value, a quantile sketch of the values, and one of the distinct clients.

    Panes are small and of bounded size, and combine before the shuffle; they are written once and merged for every window.
    """
    clients = F.lit(None).cast("string") if client is None else client.cast("string")
    found = df.groupBy(F.window(ts, pane).alias("w"), *labels).agg(
        F.count(value).alias("n"),
        F.kll_sketch_agg_double(value.cast("double"), size).alias("value_sketch"),
        F.hll_sketch_agg(clients, 12).alias("client_sketch"),
    )
    return found.select(F.col("w.start").alias("pane_start"), *labels, "n", "value_sketch", "client_sketch")


def from_panes(panes: DataFrame, labels: Sequence[str], width: str, slide: str | None = None, quantiles: dict[str, float] = QUANTILES) -> DataFrame:
    """Quantiles and distinct clients per window of whole panes: (window_start, labels, n, clients, a column per quantile)."""
    merged = panes.groupBy(F.window("pane_start", width, slide or width).alias("w"), *labels).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("value_sketch").alias("_values"), F.hll_union_agg("client_sketch").alias("_clients")
    )
    picked = [
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_values", F.lit(float(q)))).alias(name) for name, q in quantiles.items()
    ]
    return merged.select(F.col("w.start").alias("window_start"), *labels, "n", F.hll_sketch_estimate("_clients").alias("clients"), *picked)
