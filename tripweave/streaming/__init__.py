"""Structured Streaming: sources, stateless and windowed transformations, sinks, progress."""
