"""Real-estate and territory analytics as Spark DataFrame jobs."""
