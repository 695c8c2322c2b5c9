"""Incremental scoring of schedule files as they arrive."""
