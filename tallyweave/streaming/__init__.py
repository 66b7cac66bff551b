"""Linkage of records as they arrive."""
