"""Structured Streaming jobs over arriving requests."""
