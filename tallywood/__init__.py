"""User-level analytics for ratings, reviews, orders and detections, written as Spark jobs.

Every operator takes DataFrames and returns a DataFrame (or starts a Structured Streaming
query); nothing is collected and nothing passes through the driver.
"""
