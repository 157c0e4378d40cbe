"""Structured Streaming: the metric streams and how they are run."""
