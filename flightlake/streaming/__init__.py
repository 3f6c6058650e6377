"""Structured Streaming: tumbling event-time windows over observation records."""
