"""Structured Streaming over archives and events."""
