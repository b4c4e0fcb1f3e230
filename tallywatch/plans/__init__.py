"""Composed reports and the registry of checked queries."""
