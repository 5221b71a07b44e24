"""Structured Streaming ingestion of usage events."""
