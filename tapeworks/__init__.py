"""Market-data analytics on Spark: typed feeds, quality checks, marts, bars and lake tables."""
