"""Sources and sinks: delimited and parquet snapshots, code tables, status tables."""
