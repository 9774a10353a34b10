"""Parquet and table sinks, and the load job that strings them together."""
