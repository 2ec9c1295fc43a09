"""Fleet and road-traffic analytics as Spark jobs."""
