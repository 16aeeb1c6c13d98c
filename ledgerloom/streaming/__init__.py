"""Incremental refresh of the warehouse with Structured Streaming."""
