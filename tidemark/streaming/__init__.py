"""Streaming application of change feeds."""
