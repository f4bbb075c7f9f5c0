"""Order analytics on Spark: staging, dimensions, facts, daily metrics and analyses."""
