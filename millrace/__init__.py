"""Millrace: loading, incremental merging and profiling of tables with PySpark."""
