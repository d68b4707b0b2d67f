"""Sources (delimited files, parquet, joined per-entity files) and sinks."""
