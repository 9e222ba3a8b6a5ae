"""Scans and sinks: CSV landing files, staged Parquet tables, and the sample retail tables."""
