"""Whole flows composed from operators, sources and streams."""
