"""Daily commerce-event analytics as PySpark DataFrame jobs."""
