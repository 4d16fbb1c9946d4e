"""Incremental pick-up of new files with Structured Streaming."""
