"""Operators: functions from DataFrames to DataFrames, for all deployments, datasets or experiments at once."""
