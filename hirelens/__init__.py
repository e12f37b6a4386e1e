"""Job-market analytics as PySpark DataFrame transformations."""
