"""Whole queries and reports, with their SQL twins."""
