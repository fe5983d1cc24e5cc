"""Streaming of the vegetation-change engine."""
