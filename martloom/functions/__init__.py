"""Column to Column building blocks; every one stays inside Spark's expression engine."""
