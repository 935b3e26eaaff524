"""Incremental and streaming jobs."""
