"""Structured Streaming: archive event topics and drop repeated events."""
