"""periodlens — snapshot-table analytics on Spark.

Sub-packages:
  functions  Column expressions (sentinel-aware numerics, code/label text rules, periods)
  sources    file scans, sinks, period detection and the driver-table adapter
  operators  DataFrame operators (conform, denormalise, compare, profile, pivot, order, quality)
  plans      composed reports and the named query catalog with its SQL oracle
  streaming  incremental ingest of newly arriving snapshot files
"""

__version__ = "0.1.0"
