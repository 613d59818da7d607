"""Structured Streaming jobs: windowed sessions, recommendations per micro-batch, idempotent sinks, metrics."""
