"""Incremental (Structured Streaming) form of the activity aggregation."""
