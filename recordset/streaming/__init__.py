"""Structured Streaming: micro-batches merged into record sets."""
