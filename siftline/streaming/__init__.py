"""Structured Streaming forms of the sweep operators."""
