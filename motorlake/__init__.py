"""Vehicle-listings analytics as Spark DataFrame jobs."""
