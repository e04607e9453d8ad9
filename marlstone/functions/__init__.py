"""MySQL-compatible functions: as Spark SQL text for the dialect, and as Columns."""
