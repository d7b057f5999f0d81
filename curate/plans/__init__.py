"""Whole runs put together from operators and the store."""
