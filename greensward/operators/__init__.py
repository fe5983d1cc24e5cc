"""Operators of the vegetation-change engine."""
