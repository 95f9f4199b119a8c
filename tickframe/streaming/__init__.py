"""Structured Streaming feeds, bars, current values and sinks."""
