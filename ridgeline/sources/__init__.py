"""Scans and sinks: parquet tables, comment-tolerant CSV, headered CSV, vectors, reports."""
