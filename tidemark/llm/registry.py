"""Queries of the corpus operators and their SQL."""

from tidemark.llm import audit, chroma, exact, jaccard, language, licences, lines, neighbours, packing, phrases, pieces, quality, warc  # noqa: F401
from tidemark.llm.common import ORACLE, QUERIES  # noqa: F401
