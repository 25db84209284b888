"""Operators as functions of DataFrames."""

from tidemark.operators import allocation, bars, dividends, news, pages, portfolio  # noqa: F401
