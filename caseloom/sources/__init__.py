"""Scans and sinks: CSV and Parquet tables, event topics, the driver's tables."""
