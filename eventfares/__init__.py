"""Event listings related to travel fares, as Spark DataFrame jobs."""
