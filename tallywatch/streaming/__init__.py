"""Structured Streaming forms of the log, counters, alerts and drift checks."""
