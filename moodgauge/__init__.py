"""Batch and streaming sentiment analytics over social-media posts, on Spark DataFrames."""
