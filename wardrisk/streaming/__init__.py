"""Structured Streaming wiring."""
