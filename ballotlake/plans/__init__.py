"""Composite pipelines (C1-C8): the public API a user of the election ETL
calls. Each returns DataFrames; the caller decides when to write."""
