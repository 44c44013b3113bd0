"""clipstat: channel / item / comment analytics as lazy Spark DataFrame operators.

Layout:
  functions/  Column -> Column expressions (durations, engagement, buckets, ...)
  sources/    raw JSON snapshots, Parquet tables, the test-table adapter, sinks
  operators/  filters, joins, rollups, statistics, windows, top-k
  plans/      user-level jobs (transform, analysis, marts) and the query registry
  streaming/  incremental ingest of the landing directory
"""

__all__ = ["session", "schemas"]
