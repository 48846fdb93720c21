"""Inputs and outputs: parquet tables, CSV exports, fixture views, sinks."""
