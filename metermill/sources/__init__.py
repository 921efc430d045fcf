"""XML and schema sources, CSV sinks and Parquet staging."""
