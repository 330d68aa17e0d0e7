"""Structured Streaming jobs: spool drain and intake."""
