"""News linking: titles against patterns of companies or indices."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import french


def pattern(texts: list[str]) -> str:
    """A regular expression for any of the texts, plain and between bounds of words."""
    plain = [unicodedata.normalize("NFKD", t.replace("’", "'").replace("‘", "'")).encode("ascii", "ignore").decode().lower() for t in texts]
    return r"\b(?:" + "|".join(map(re.escape, sorted(set(plain)))) + r")\b"


def linked(titles: DataFrame, patterns: dict[str, list[str]]) -> DataFrame:
    """id, key, n_keys, outcome ('linked' with one key, 'ambiguous' with several, 'unlinked') for titles (id, title).

    Patterns are settings of the job, a few for each key: they become expressions, so the titles are read once and nothing is joined.
    """
    text = F.col("plain_")
    hits = [F.when(text.rlike(pattern(texts)), F.lit(key)) for key, texts in sorted(patterns.items()) if texts]
    keys = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    own = titles.select("id", french.plain(F.col("title")).alias("plain_")).select("id", keys.alias("keys_"))
    n = F.size("keys_")
    return own.select("id", F.when(n == 1, F.get("keys_", F.lit(0))).alias("key"), n.alias("n_keys"), F.when(n == 1, "linked").when(n > 1, "ambiguous").otherwise("unlinked").alias("outcome"))


def link_statistics(links: DataFrame) -> DataFrame:
    return links.agg(F.count("*").alias("total"), *(F.count_if(F.col("outcome") == o).alias(o) for o in ("linked", "ambiguous", "unlinked")))


def selected(news: DataFrame, needle: str = "", category: str | None = None, since=None, until=None) -> DataFrame:
    """News (title, category, date) by text (any case; none is all), category and dates, both included."""
    own = news.where(F.lower("title").contains(needle.lower())) if needle else news
    own = own if category is None else own.where(F.col("category") == category)
    own = own if since is None else own.where(F.col("date") >= F.lit(since))
    return own if until is None else own.where(F.col("date") <= F.lit(until))
