"""Repeated inputs, cache hits, request rates and concurrency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.ordered import previous_row, running_totals

MICROS = 1_000_000


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, in a session that runs in UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def window_start(at: Column, width: int) -> Column:
    """Start of the window of `width` microseconds that holds a moment, in whole-number arithmetic."""
    return at - F.pmod(at, F.lit(width).cast("bigint"))


def duplicates(df: DataFrame, hash_column: str = "input_hash", id_column: str = "id") -> DataFrame:
    """Per input hash: the row to keep (lowest id) and how often the input occurs."""
    return df.groupBy(hash_column).agg(F.min(id_column).alias("kept_id"), F.count("*").alias("occurrences"))


def first_of_each(df: DataFrame, hash_column: str = "input_hash", id_column: str = "id") -> DataFrame:
    """The kept row of every input; copies fall away before the shuffle, so a hot input costs no more than another."""
    others = [c for c in df.columns if c not in (hash_column, id_column)]
    first = df.groupBy(hash_column).agg(F.min_by(F.struct(id_column, *others), id_column).alias("kept"))
    return first.select(hash_column, "kept.*")


def repeats_within(
    logs: DataFrame, seconds: int = 300, key: str = "input_hash", ts: str = "predicted_at", id_column: str = "id"
) -> DataFrame:
    """Each row with the time since the same input was last seen, and whether a cache of that age would have hit."""
    rows = logs.select(key, id_column, ts, micros(F.col(ts)).alias("_at"))
    bucket = window_start(F.col("_at"), seconds * MICROS)
    seen = previous_row(rows, [key], ["_at", id_column], {"_before": "_at"}, bucket)
    gap = (F.col("_at") - F.col("_before")) / F.lit(float(MICROS))
    return seen.select(
        key,
        id_column,
        ts,
        gap.alias("seconds_since"),
        (F.col("_before").isNotNull() & (F.col("_at") - F.col("_before") <= seconds * MICROS)).alias("would_hit"),
    )


def sliding_counts(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, bucket_seconds: int = 3600
) -> DataFrame:
    """For each key and distinct time: rows in the `seconds` up to and including it.

    Every time adds its rows and takes them off again `seconds` later; a running total then replaces a sliding frame,
    which would look at the whole window again for every row.
    """
    at = df.select(*keys, micros(F.col(ts)).alias("at")).groupBy(*keys, "at").agg(F.count("*").alias("n"))
    steps = at.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("at").alias("at"), F.lit(0).alias("step"), F.col("n").alias("n")),
                F.struct((F.col("at") + seconds * MICROS).alias("at"), F.lit(1).alias("step"), (-F.col("n")).alias("n")),
            )
        ),
    )
    bucket = window_start(F.col("at"), bucket_seconds * MICROS)
    running = running_totals(steps, keys, [F.col("at"), F.col("step")], ["n"], bucket)
    return running.filter(F.col("step") == 0).select(*keys, from_micros(F.col("at")).alias(ts), F.col("n").alias("n"))


def over_rate(df: DataFrame, keys: Sequence[str], ts: str, seconds: int = 60, limit: int = 100) -> DataFrame:
    """Moments at which a client had more than `limit` requests in the last `seconds`."""
    return sliding_counts(df, keys, ts, seconds).filter(F.col("n") > limit)


def concurrency(
    df: DataFrame, start: str, duration_micros: Column, keys: Sequence[str] = (), bucket_seconds: int = 300
) -> DataFrame:
    """Requests in flight at every moment one starts or ends: columns keys, `at` (microseconds), `active`."""
    began = micros(F.col(start))
    steps = df.select(
        *keys,
        F.inline(
            F.array(
                F.struct(began.alias("at"), F.lit(1).alias("active")),
                F.struct((began + duration_micros).alias("at"), F.lit(-1).alias("active")),
            )
        ),
    )
    net = steps.groupBy(*keys, "at").agg(F.sum("active").alias("active"))
    bucket = window_start(F.col("at"), bucket_seconds * MICROS)
    return running_totals(net, keys, [F.col("at")], ["active"], bucket)


def peak_concurrency(
    df: DataFrame, start: str, duration_micros: Column, keys: Sequence[str] = (), window_seconds: int = 300
) -> DataFrame:
    """Greatest number of requests in flight per window that saw one start or end."""
    moments = concurrency(df, start, duration_micros, keys, window_seconds)
    grouped = moments.groupBy(*keys, window_start(F.col("at"), window_seconds * MICROS).alias("_start"))
    return grouped.agg(F.max("active").alias("peak_active")).select(
        *keys, from_micros(F.col("_start")).alias("window_start"), "peak_active"
    )
