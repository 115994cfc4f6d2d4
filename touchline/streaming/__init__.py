"""Structured Streaming jobs: list ingest and patching as logs arrive."""
