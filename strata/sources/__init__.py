"""Scans and sinks: parquet/CSV readers, EHR-shaped stand-in views, writers."""

from strata.sources.tables import read_table  # noqa: F401
