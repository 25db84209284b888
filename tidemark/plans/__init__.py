"""Market analytics operators for Spark."""
