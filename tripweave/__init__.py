"""tripweave: trip analytics on Spark's DataFrame, SQL, ML and Structured Streaming APIs."""
