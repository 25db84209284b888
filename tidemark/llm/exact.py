"""Operator 5: exact deduplication by a stateful stream.

A stream of fingerprints (SHA-256 of the normalised text, doc_id, locator) runs
through a streaming aggregation whose state stays in RocksDB without expiry: for
each digest the number of rows and the stable identifier and content locator of the
row that stays, the one with the largest doc_id. The state is then read as a table.
Rows whose digest was hit again are fetched by their locators and their full
normalised bytes compared; should a digest hold two texts, its rows are told apart
by the texts themselves.

Normalising lower-cases A-Z only. Null texts count as empty; null doc_ids rank
lowest (a group of null ids keeps null); repeated rows count as rows of one group.
Other columns of the input are not read. Everything runs on built-in functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ORACLE, QUERIES, ascii_lower, shared_folder, table, written

ROCKS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # a store that stays open holds disk set aside for it
}


def located(docs: DataFrame) -> DataFrame:
    """Text and where it is stored: the file and the row in it."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def fingerprints(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    sha = F.unhex(F.sha2(ascii_lower(F.col("text")).cast("binary"), 256))
    return located(docs).select("doc_id", sha.alias("sha"), F.substring(sha, 1, digest_bytes).alias("digest"), "file", "row")


def stream_state(spark: SparkSession, path: str, schema, files_per_batch: int = 64, checkpoint: str | None = None) -> DataFrame:
    """digest, n, keep_id, file, row after the stream has taken every file of fingerprints at the path.

    With the same checkpoint a later call takes only new files, and the state goes on from where it was.
    """
    checkpoint = checkpoint or shared_folder(spark, "dedup-state")
    before = {k: spark.conf.get(k, None) for k in ROCKS}
    for k, v in ROCKS.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        seen = stream.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "file", "row")).alias("kept"))
        query = seen.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    count, kept = state.schema["value"].dataType.names
    value = lambda name: F.col("value").getField(name)
    return state.select(F.col("key.digest").alias("digest"), value(count).alias("n"), value(kept).getField("doc_id").alias("keep_id"), value(kept).getField("file").alias("file"), value(kept).getField("row").alias("row"))


def exact_dedup(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for a table of files with doc_id and text.

    digest_bytes shortens the state's key, for tests of colliding digests.
    """
    spark = docs.sparkSession
    prints = fingerprints(docs, digest_bytes)
    path = shared_folder(spark, "fingerprints")
    prints.write.parquet(path)
    prints = spark.read.schema(prints.schema).parquet(path)
    groups = written(stream_state(spark, path, prints.schema).where("n > 1"), "groups")
    # Hits: full bytes, fetched by locator (rows are dealt evenly), one text per task and digest from there on.
    hits = prints.join(groups.select("digest"), "digest", "left_semi").select("digest", "file", "row")
    texts = located(docs).join(hits, ["file", "row"]).select("digest", "file", "row", "doc_id", ascii_lower(F.col("text")).alias("text"))
    split = texts.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low <> high").select("digest")
    split = written(split, "split")
    own = F.struct("doc_id", "file", "row")
    plain = prints.join(groups.select("digest", F.col("n").alias("n_"), F.struct("keep_id", "file", "row").alias("kept_")), "digest", "left").select("*", F.struct(F.col("kept_.keep_id").alias("doc_id"), "kept_.file", "kept_.row").alias("best_"))
    if split.limit(1).count():
        texts = texts.join(split, "digest", "left_semi")
        apart = texts.groupBy("digest", "text").agg(F.count("*").alias("m_"), F.max(own).alias("own_"))
        apart = texts.join(apart, ["digest", "text"]).select("file", "row", "m_", "own_")
        plain = plain.join(apart, ["file", "row"], "left").withColumn("n_", F.coalesce("m_", "n_")).withColumn("best_", F.coalesce("own_", "best_"))
    alone = F.col("n_").isNull()
    kept = alone | ((F.col("best_.file") == F.col("file")) & (F.col("best_.row") == F.col("row")))
    return plain.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best_.doc_id")).alias("keep_id"), F.coalesce("n_", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


QUERIES["op5_exact_dedup"] = op5_exact_dedup
ORACLE["op5_exact_dedup"] = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
