"""Structured Streaming form of the transform and load jobs."""
