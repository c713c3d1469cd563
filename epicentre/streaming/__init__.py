"""Structured Streaming ingest of landed feed snapshots."""
