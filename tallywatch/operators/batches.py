"""User functions over batches, metrics and rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def map_batches(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, drop: Sequence[str] = ()
) -> DataFrame:
    """Apply a function to Arrow-sized batches; `drop` removes input columns the function does not need."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.drop(*drop).mapInPandas(run, schema)


def metric_callback(
    df: DataFrame, function: Callable[[pd.Series, pd.Series, pd.Series], dict[str, float]], names: Sequence[str],
    keys: Sequence[str], label: str = "label", predicted: str = "predicted_label",
) -> DataFrame:
    """Metrics of a user function per key.

    The function gets labels, predictions and how often each pair occurs: one entry per pair of classes, whatever the
    number of rows, so no group of rows is ever gathered.
    """
    scored = df.filter(F.col(label).isNotNull())
    counts = scored.groupBy(*keys, label, predicted).agg(F.count("*").alias("n"))
    key_types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = ", ".join([key_types, *[f"`{n}` double" for n in names]])

    def run(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        found = function(cells[label], cells[predicted], cells["n"])
        return pd.DataFrame([dict(zip(keys, key)) | {n: float(found[n]) for n in names}])

    return counts.groupBy(*keys).applyInPandas(run, schema)


