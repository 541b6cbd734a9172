"""Readers, feeds and sinks."""
