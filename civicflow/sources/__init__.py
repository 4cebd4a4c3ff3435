"""Readers and writers: raw landing zone, incremental extracts, published snapshots."""
