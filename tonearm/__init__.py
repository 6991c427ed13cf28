"""Music-catalogue analytics written as plain Spark DataFrame jobs."""
