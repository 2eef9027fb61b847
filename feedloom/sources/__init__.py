"""Sources and sinks: raw JSON lines, parquet contract tables, the source
audit, and record views over the driver's test tables."""
