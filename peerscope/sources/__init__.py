"""Sources and sinks: typed CSV scans, partitioned Parquet, sorted writes, footer audits."""
