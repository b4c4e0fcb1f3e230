"""Registry pairing each Spark query with the SQL another engine checks it by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywatch.plans.oracle_views import VIEWS
from tallywatch.sources.canonical import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(names: str, body: str) -> str:
    """Prefix the SQL with the named canonical views; the body may start with its own WITH list."""
    views = ", ".join(f"{name} AS ({VIEWS[name]})" for name in names.split())
    if not views:
        return body.strip()
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {views}, {body[5:]}"
    return f"WITH {views} {body}"


def query(name: str, views: str = "", sql: str | None = None) -> Callable:
    """Register a function of `Tables`; `sql` is its oracle over the named views."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return build

    return register


def settled(expression: str, digits: int = 6) -> str:
    """SQL twin of `functions.numeric.settle`."""
    scale = f"CAST(1e{digits} AS DOUBLE)"
    return f"floor(({expression}) * {scale} + CAST(0.500001 AS DOUBLE)) / {scale}"
