"""Structured Streaming: starting queries, replay-safe batch sinks, fan-out."""
