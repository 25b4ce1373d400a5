"""Structured Streaming forms of the fleet jobs."""
