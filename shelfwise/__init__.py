"""Product-recommendation analytics as PySpark DataFrame jobs."""
