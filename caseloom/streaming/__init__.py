"""Structured Streaming queries over surveillance events."""
