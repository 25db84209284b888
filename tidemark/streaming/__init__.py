"""Streams."""

from tidemark.streaming import ingest  # noqa: F401
