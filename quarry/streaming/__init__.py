"""Structured Streaming twins of the incremental ingestion operators."""
