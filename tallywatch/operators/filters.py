"""Lookbacks and equality lookups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(value: str | datetime) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(str(value)).cast("timestamp_ntz")


def since(df: DataFrame, column: str, as_of: str | datetime, hours: float = 0, days: float = 0) -> DataFrame:
    """Rows at or after `as_of` minus the lookback; the bound is folded to a literal and reaches the scan."""
    back = F.make_dt_interval(F.lit(int(days)), F.lit(int(hours)), F.lit(0), F.lit(0.0))
    return df.filter(F.col(column) >= moment(as_of) - back)


def by_value(df: DataFrame, **wanted: object) -> DataFrame:
    """Rows whose columns equal the given values; arguments that are None do not filter."""
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def one_by_value(df: DataFrame, **wanted: object) -> DataFrame:
    """The single row of a unique key."""
    return by_value(df, **wanted).limit(1)


def within(df: DataFrame, column: str, allowed: list | tuple) -> DataFrame:
    """Rows whose column is in a closed set."""
    return df.filter(F.col(column).isin(list(allowed)))


def newest(df: DataFrame, column: str, limit: int, tie: str = "id", offset: int = 0) -> DataFrame:
    """A page of rows, newest first; the id settles ties."""
    ordered = df.orderBy(F.col(column).desc(), F.col(tie).desc())
    return (ordered.offset(offset) if offset else ordered).limit(limit)
