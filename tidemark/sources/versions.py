"""Versions of stored tables, made by one writer each."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has made the version that this one was about to make."""


class Versions:
    """Numbered texts below a path. A commit creates its number's file and fails where it exists (the file system must offer that); a text counts once it is whole."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self.spark, self.path = spark, jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
        self.new_path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path.getFileSystem(spark._jsc.sc().hadoopConfiguration())

    def latest(self) -> tuple[int, str]:
        """Number and text; 0 and an empty text where nothing was committed."""
        names = sorted((s.getPath().getName() for s in self.fs.listStatus(self.path)), reverse=True) if self.fs.exists(self.path) else []
        for name in (n for n in names if n.isdigit()):
            rows = self.spark.read.text(f"{self.path.toString()}/{name}", wholetext=True).collect()
            if rows and rows[0].value.endswith("\n"):
                return int(name), rows[0].value
        return 0, ""

    def commit(self, number: int, text: str) -> None:
        at = self.new_path(self.path, f"{number:012d}")
        if self.fs.exists(at):
            raise Conflict(f"version {number} exists")
        try:
            out = self.fs.create(at, False)
        except Exception as e:
            raise Conflict(f"version {number} exists") from e
        out.write(bytearray((text + "\n").encode()))
        out.close()
