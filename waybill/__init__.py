"""Logistics analytics on Spark DataFrames and Structured Streaming."""
