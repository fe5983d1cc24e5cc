"""Helpers that shape physical plans: scratch tables, checked broadcasts."""
