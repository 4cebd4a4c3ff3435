"""Whole jobs composed from the operators: ingest, transform, load, dashboard queries."""
