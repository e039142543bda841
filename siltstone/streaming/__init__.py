"""Incremental ingestion and micro-batch warehouse maintenance."""
