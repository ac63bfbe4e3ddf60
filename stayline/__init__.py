"""stayline: readmission analytics on Spark DataFrames.

Layers: ``sources`` (schemas, typed CSV ingest, driver-table fixtures, loads),
``functions`` (column helpers with the exact date/string semantics),
``operators`` (skew-safe ordered scans, interval logic, quality checks,
profiles), ``plans`` (the models and the profiling / validation queries) and
``streaming`` (file gate and exactly-once loads on Structured Streaming).
"""

__all__ = ["session"]
