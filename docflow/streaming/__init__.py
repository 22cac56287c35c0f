"""Structured Streaming forms of the stages."""
