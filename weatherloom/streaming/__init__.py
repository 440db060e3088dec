"""Structured Streaming forms of the daily table."""
