"""Sources and sinks: readers (A1-A5), fixture views over the driver's
tables, fixed dimensions (A7), Parquet sinks, partition rewrites
(B1-B5, B19, partition-scoped MERGE)."""
