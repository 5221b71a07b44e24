"""The named pipelines: usage, billing, reports, quality, ingestion."""
