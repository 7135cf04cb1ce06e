"""clickweave: clickstream analytics on Spark."""
