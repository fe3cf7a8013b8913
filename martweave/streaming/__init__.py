"""Structured Streaming versions of the folder-driven jobs."""
