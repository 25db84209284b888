"""Tables in parts: a merge rewrites the parts that it touches and works derived columns out anew where they may change."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.scratch import written
from tidemark.sources.sinks import merged
from tidemark.sources.versions import Conflict, Versions  # noqa: F401


class PartedTable:
    """Rows by key and date, in parts of the date (years, say), below a path.

    A part is a folder that is never changed; a version says which folder holds each part, so
    readers see whole versions and untouched parts keep their files. With derive, each row also
    has columns that derive(rows) adds from a row and the row before it of its key. For that the
    last row of each key in each part is stored apart, so a merge need not read other parts.
    """

    def __init__(self, spark: SparkSession, path: str, part: Column, key: str = "symbol", date: str = "date", derive: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.path, self.key, self.date = spark, path.rstrip("/"), key, date
        self.part, self.derive, self.versions = part.cast("string"), derive or (lambda rows: rows), Versions(spark, path.rstrip("/"))

    def state(self) -> tuple[int, dict]:
        """Number of the version, and its folders by part, raw and whole schema; a row for each part comes to the driver."""
        number, text = self.versions.latest()
        return number, json.loads(text) if text else {"parts": {}, "raw": None, "schema": None}

    def _of(self, state: dict, parts, kind: str, schema: str) -> DataFrame | None:
        paths = [f"{self.path}/{kind}-{state['parts'][p]}/part_={p}" for p in sorted(parts)]
        return self.spark.read.schema(StructType.fromJson(state[schema])).parquet(*paths) if paths else None

    def read(self) -> DataFrame | None:
        state = self.state()[1]
        return self._of(state, state["parts"], "data", "schema")

    def merge(self, source: DataFrame, order: str | None = None) -> list[str]:
        """Upserts rows (key, date and other columns, the same in each merge) and returns the parts written. Rows without a key or date are left out; replaying a merge changes no row."""
        number, state = self.state()
        raw = source.columns
        source = written(merged(None, source.where(F.col(self.key).isNotNull() & F.col(self.date).isNotNull()), [self.key, self.date], order), "increment")
        touched = [r[0] for r in source.select(self.part.alias("p")).distinct().collect()]
        if not touched:
            return []
        rest = [p for p in state["parts"] if p not in touched]
        # Parts that hold the row after a touched one of the same key.
        edges = self._of(state, rest, "edges", "raw")
        follow = []
        if edges is not None:
            later = edges.select(self.key, F.col(self.date).alias("later_"))
            after = source.groupBy(self.key, self.part.alias("of_")).agg(F.max(self.date).alias("upto_")).join(later, self.key).where("later_ > upto_").groupBy(self.key, "of_").agg(F.min("later_").alias(self.date))
            follow = [r[0] for r in after.select(self.part.alias("p")).distinct().collect()]
        known = [p for p in touched if p in state["parts"]]
        old = self._of(state, known, "data", "schema")
        rows = merged(old.select(*raw) if old is not None else None, source, [self.key, self.date], order).select(*raw)
        if follow:
            rows = rows.unionByName(self._of(state, follow, "data", "schema").select(*raw))
        rows = rows.withColumn("given_", F.lit(True))
        before = [p for p in rest if p not in follow]
        if before:
            rows = rows.unionByName(self._of(state, before, "edges", "raw").select(*raw).withColumn("given_", F.lit(False)))
        whole = self.derive(rows).where("given_").drop("given_")
        name = uuid.uuid4().hex
        whole.withColumn("part_", self.part).repartition("part_", self.key).write.partitionBy("part_").parquet(f"{self.path}/data-{name}")
        schema = json.loads(whole.schema.json())
        new = {"parts": state["parts"] | dict.fromkeys([*touched, *follow], name), "schema": schema, "raw": json.loads(whole.select(*raw).schema.json())}
        last = Window.partitionBy(self.key, "part_").orderBy(F.desc(self.date))
        own = self._of(new, [*touched, *follow], "data", "schema").select(*raw).withColumn("part_", self.part)
        own.withColumn("rank_", F.row_number().over(last)).where("rank_ = 1").drop("rank_").write.partitionBy("part_").parquet(f"{self.path}/edges-{name}")
        self.versions.commit(number + 1, json.dumps(new))
        return sorted([*touched, *follow])


def changes(rows: DataFrame) -> DataFrame:
    """The change to the close before, in percent of two digits (half to even), for PartedTable; null on a first row."""
    before = F.lag("close").over(Window.partitionBy("symbol").orderBy("date"))
    return rows.withColumn("change", F.bround(100 * (F.try_divide("close", before) - 1), 2))
