"""Imports every check module, which fills the registry."""

from tallywatch.plans import (  # noqa: F401
    check_drift,
    check_entities,
    check_scoring,
    check_series,
    check_tables,
    check_texts,
    check_usage,
)
from tallywatch.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
