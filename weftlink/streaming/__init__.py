"""Incremental matching on a stream."""
