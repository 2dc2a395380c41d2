"""Customer analytics over retail transactions as PySpark DataFrame jobs."""
