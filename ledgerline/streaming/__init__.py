"""Structured Streaming forms of the ingest operators (ratings arriving continuously)."""
