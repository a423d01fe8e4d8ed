"""Incremental intake of snapshots with Structured Streaming."""
