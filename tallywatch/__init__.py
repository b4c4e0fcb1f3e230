"""Tallywatch: Spark jobs that watch text classifiers and the data they are trained and scored on."""

from tallywatch.session import build_session

__all__ = ["build_session"]
