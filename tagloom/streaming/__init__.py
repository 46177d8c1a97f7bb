"""Structured Streaming twins of the ingest and scoring jobs."""
