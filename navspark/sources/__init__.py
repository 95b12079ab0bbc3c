"""Sources (landed JSON, parquet, fixed dimension, test-table adapters) and sinks."""
