"""flightlake: aircraft-telemetry analytics as Spark DataFrame operators.

Sub-packages:
  sources    readers and writers (JSON snapshots, window Parquet, CSV dimensions, catalog)
  functions  column expressions (ratios, bands, status, coercion, time formats)
  operators  DataFrame -> DataFrame analytics (enrichment, profiles, anomalies, density, forest)
  plans      join helpers, role views over the driver tables, refresh job, query registry
  streaming  Structured Streaming windows and the window-file sink
"""

__version__ = "0.1.0"
