"""Structured Streaming jobs over the events table."""
