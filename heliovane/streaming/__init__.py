"""Structured Streaming over the hourly feed."""
