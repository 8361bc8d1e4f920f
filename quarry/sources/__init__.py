"""Readers, parsers and writers for files, elements and chunks."""
