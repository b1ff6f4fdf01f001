"""Structured Streaming operators for activity events."""
