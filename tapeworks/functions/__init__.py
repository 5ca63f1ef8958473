"""Column expressions; all of them built from native Spark functions."""
