"""Structured Streaming over the run log."""
