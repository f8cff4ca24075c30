"""Structured Streaming jobs: landing ingest (ST1), minute aggregates (ST2), dedupe (ST3)."""
