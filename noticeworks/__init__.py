"""Public-records analytics as Spark DataFrame jobs."""
