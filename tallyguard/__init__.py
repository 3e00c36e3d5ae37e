"""Transaction-risk analytics on Spark tables and streams."""
