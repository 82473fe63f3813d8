"""Structured Streaming jobs: incremental ingest, routing, deduplication, snapshots."""
