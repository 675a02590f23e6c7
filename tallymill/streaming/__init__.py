"""Structured Streaming operators over order events."""
