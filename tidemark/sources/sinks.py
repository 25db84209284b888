"""Sinks and replayable upserts: each version of a table is a folder of its own, named by a small pointer file."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.versions import Versions


def merged(target: DataFrame | None, source: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Rows of both; of equal keys that of the source, of these that of the largest order (or row). Replaying it changes nothing."""
    own = source.withColumn("given_", F.lit(1))
    if target is not None:
        own = target.withColumn("given_", F.lit(0)).unionByName(own, allowMissingColumns=True)
    # Maps have no order; their texts do.
    names = [F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in own.dtypes if c not in ("given_", *keys)]
    best = Window.partitionBy(*keys).orderBy(F.desc("given_"), *([F.desc(order)] if order else []), *(F.desc(c) for c in names))
    return own.withColumn("rank_", F.row_number().over(best)).where("rank_ = 1").drop("rank_", "given_")


def inserted(target: DataFrame, source: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The target and rows of the source with keys that it lacks, the first by order of each."""
    new = source.join(target.select(*keys).distinct(), keys, "left_anti")
    first = Window.partitionBy(*keys).orderBy(order)
    return target.unionByName(new.withColumn("rank_", F.row_number().over(first)).where("rank_ = 1").drop("rank_"), allowMissingColumns=True)


def updated(target: DataFrame, values: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The target with columns from values (unique keys) where they are not null there; it clears nothing."""
    new = values.select(*keys, *(F.col(c).alias(f"{c}_new") for c in columns))
    own = target.join(new, keys, "left")
    return own.select(*(F.coalesce(f"{c}_new", c).alias(c) if c in columns else F.col(c) for c in target.columns))


class StoredTable:
    """A table below a path. A write makes a new folder and commits it as the next version, so readers see whole versions only and of two writers at once one fails (versions.Conflict)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Versions(spark, self.path)

    def _read(self, text: str) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/{text.strip()}") if text else None

    def read(self) -> DataFrame | None:
        return self._read(self.versions.latest()[1])

    def write(self, rows: DataFrame, partition_by: list[str] | None = None, number: int | None = None) -> DataFrame:
        """number: the version that the rows were made from; the latest, if none is given."""
        number = self.versions.latest()[0] if number is None else number
        name = f"data-{uuid.uuid4().hex}"
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        writer.parquet(f"{self.path}/{name}")
        self.versions.commit(number + 1, name)
        return self._read(name)

    def upsert(self, source: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
        """Writes the whole table anew; where increments touch a few parts of it, PartedTable writes those alone."""
        number, text = self.versions.latest()
        return self.write(merged(self._read(text), source, keys, order), number=number)


def increments(target: DataFrame, source: DataFrame, key: str, date: str) -> DataFrame:
    """Rows of the source after the target's last date of their key; keys that it lacks come whole."""
    since = target.groupBy(key).agg(F.max(date).alias("since_"))
    return source.join(since, key, "left").where(F.col("since_").isNull() | (F.col(date) > F.col("since_"))).drop("since_")


def unknown_ids(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    return source.join(target.select(key).distinct(), key, "left_anti")


def to_french_csv(rows: DataFrame, path: str, decimals: int = 2) -> None:
    """Semicolons and decimal commas; no byte order mark."""
    point = lambda c: F.replace(F.format_string(f"%.{decimals}f", F.col(c).cast("double")), F.lit("."), F.lit(","))
    rows.select(*(F.when(F.col(c).isNotNull(), point(c)).alias(c) if t in ("double", "float") or t.startswith("decimal") else F.col(c) for c, t in rows.dtypes)).write.csv(path, sep=";", header=True)


def to_keyed_documents(rows: DataFrame, path: str, key: str, group: list[str] | None = None) -> None:
    """One document for each group (or for each key): the key and the rest of its row, as JSON lines."""
    rest = [c for c in rows.columns if c != key and c not in (group or [])]
    if group:
        rows.groupBy(*group).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, F.struct(*rest))))).alias("rows")).write.json(path)
    else:
        rows.select(key, F.struct(*rest).alias("row")).write.json(path)


def by_status(rows: DataFrame, path: str, status: str = "statut") -> None:
    rows.write.partitionBy(status).parquet(path)


def wide_sheet(rows: DataFrame, index: str, column: str, value: str, columns: list[str]) -> DataFrame:
    """A row for each index and a column for each of the named values; the names are given, so nothing is scanned for them."""
    return rows.groupBy(index).pivot(column, columns).agg(F.first(value)).orderBy(index)


def match_preview(links: DataFrame, titles: DataFrame, path: str) -> None:
    """What linking would do, for review: linked and ambiguous titles with their keys, as CSV; unlinked ones are left out."""
    own = titles.select("id", "title").join(links.select("id", "key", "n_keys", "outcome"), "id")
    linked = own.where("outcome = 'linked'").select("outcome", "id", "title", "key")
    ambiguous = own.where("outcome = 'ambiguous'").select("outcome", "id", "title", F.format_string("%d keys", "n_keys").alias("key"))
    linked.unionByName(ambiguous).write.csv(path, sep=";", header=True, escape='"')
