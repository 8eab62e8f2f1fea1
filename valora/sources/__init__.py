"""Scans and sinks: delimited tables, cached JSON pages, processed Parquet tables."""
