"""Compositions of operators: ingest and retrieval."""
