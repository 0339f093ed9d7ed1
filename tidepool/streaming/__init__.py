"""Structured Streaming use of the stateless cleaners."""
