"""Structured Streaming form of the jobs."""
