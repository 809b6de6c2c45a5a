"""Structured Streaming twins of the item rollups and run filters."""
