"""Structured Streaming: validation, scoring, deduplication, order lifecycle and bias over time."""
