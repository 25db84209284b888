"""What the corpus operators share: the shared folder, written tables, hashing."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: What operators keep in a Python worker from task to task, by name; see released.
STORES: dict[str, dict] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset (tests) and all runs on one machine, below a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here and lost executors cost nothing before it."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def removed(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for t in tables:
        folder = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.written_path)
        folder.getFileSystem(t.sparkSession._jsc.sc().hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column):
    """A-Z only; F.lower would fold other letters too."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc32_mod(doc_id, n: int):
    """crc32 of the id as text, modulo n; null ids count as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def hash_sample(rows: DataFrame, id_column: str, size: int) -> DataFrame:
    """The rows whose id's hash is among the size smallest: a bounded sample, the same for any partitioning."""
    own = rows.withColumn("hash_", F.xxhash64(F.lit(7), F.col(id_column)))
    top = own.select("hash_").orderBy("hash_").limit(size).agg(F.max("hash_")).first()[0]
    return own.where(F.col("hash_") <= F.lit(top if top is not None else 0)).drop("hash_")


def appended(df: DataFrame, text: str, fields: str, compute: Callable) -> DataFrame:
    """All columns of df and the named fields, which compute(list of texts) gives as Arrow arrays, a slice of rows at a time."""
    import pyarrow as pa

    names = df.columns
    new = [f.split()[0] for f in fields.split(",")]
    assert not set(new) & set(names), "a new column's name is taken"
    at = names.index(text)

    def add(batches):
        released()
        for batch in batches:
            for part in slices(batch, at):
                got = compute(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *got], [*names, *new])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(add, f"{schema}, {fields}")


def released(*kept: str) -> None:
    """Drops what other operators' tasks have kept in this worker; a task that keeps nothing itself begins with it."""
    for name, store in STORES.items():
        if name not in kept:
            store.clear()


def slices(batch, at: int, most: int = 1_000_000, rows: int = 512):
    """Parts of the batch with about this many bytes of text at most, or one row."""
    sizes = np.zeros(batch.num_rows + 1, np.int64)
    import pyarrow.compute as pc

    sizes[1:] = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, min(start + rows, int(np.searchsorted(sizes, sizes[start] + most, "right")) - 1))
        yield batch.slice(start, end - start)
        start = end
