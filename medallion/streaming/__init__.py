"""Incremental runs: file streams, per-consumer merges."""
