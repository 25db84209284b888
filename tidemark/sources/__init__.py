"""Scans and sinks."""

from tidemark.sources import files, sinks  # noqa: F401
