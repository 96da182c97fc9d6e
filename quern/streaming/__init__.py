"""Structured Streaming forms of the resumable stages."""
