"""Structured Streaming: parsing, deduplication, routing and counters."""
