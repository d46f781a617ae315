"""Whole flows: inputs derived from the given tables, landing, marts, query catalogue."""
