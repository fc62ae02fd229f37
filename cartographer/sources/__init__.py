"""Sources and sinks: driver tables, fixture views, typed CSV, Parquet sinks."""
