"""Structured Streaming sinks and keyed-state operators."""
