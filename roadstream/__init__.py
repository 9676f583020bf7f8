"""Vehicle-detection analytics on Spark DataFrames and Structured Streaming."""
