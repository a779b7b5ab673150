"""tidegrid: station-level demand analytics as plain Spark DataFrame jobs."""
