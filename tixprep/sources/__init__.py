"""Sources and sinks: the ticket view over the driver tables, guarded scans, Parquet bundle I/O."""
