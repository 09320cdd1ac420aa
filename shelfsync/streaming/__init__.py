"""Structured Streaming form of the sync."""
