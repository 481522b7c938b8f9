"""Customer analytics for marketplace data, written as PySpark DataFrame jobs."""
