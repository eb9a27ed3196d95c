"""Structured Streaming jobs for listings."""
