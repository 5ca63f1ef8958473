"""Structured Streaming: windowed aggregates and the set of running queries."""
