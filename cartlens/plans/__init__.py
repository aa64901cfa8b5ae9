"""Whole results: the published tables, and event views over other schemas."""
