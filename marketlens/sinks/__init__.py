"""Sinks: Parquet datasets, JSON lines, CSV and catalog tables."""

from marketlens.sinks.parquet import write_csv, write_json, write_table  # noqa: F401
