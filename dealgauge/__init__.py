"""Lead analytics as Spark DataFrame jobs."""
