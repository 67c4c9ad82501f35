"""Customer-review analytics on Spark: raw files to bronze, silver and gold tables."""
