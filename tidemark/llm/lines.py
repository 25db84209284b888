"""Operator 2: reversible line deduplication with sharded cuckoo filters.

A line's key is the line stripped of ASCII white space and lower-cased (A-Z), as a
128-bit digest. The index holds postings (document, key), an exact reference-count
table (key, documents, smallest document) and, by shard of keys, a cuckoo filter of
the keys that two documents or more hold. Inserting documents raises counts, deleting
them lowers counts, and a key that gains its second document or loses it enters or
leaves its shard's filter; so a deletion takes back what an insertion did.

Rewriting sends each line's key to its shard, where the filter rules most lines out
and the exact table decides the rest: a line goes if a smaller doc_id holds its key.
Shards with many lines are dealt in parts. Each version of the index is written to the
shared folder; nothing is kept in a task beyond one shard's shared keys.

Null texts count as one empty line; keys under 10 code points are left alone; rows
with null ids keep all lines and are not indexed. Repeated rows of an id count once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ORACLE, QUERIES, mix64, released, slices, table, written

LEAST = 10
WHITE = " \t\n\x0b\x0c\r"
PER_SHARD = 100_000
PER_PART = 500_000
SLOTS = 4


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key may stand in either of two buckets."""

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots.reshape(-1, SLOTS).copy()
        self.mask = len(self.slots) - 1

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(2, int(np.ceil(np.log2(max(keys, 1) / (SLOTS * 0.7) + 1)))))

    @classmethod
    def loaded(cls, raw: bytes) -> CuckooFilter:
        return cls(0, np.frombuffer(raw, "<u2"))

    def dumped(self) -> bytes:
        return self.slots.astype("<u2").tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mix64(keys)
        prints = (h >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (h & np.uint64(self.mask)).astype(np.int64)
        return prints, first, self.other(first, prints)

    def other(self, bucket, prints):
        return bucket ^ (mix64(np.atleast_1d(prints).astype(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def insert(self, keys: np.ndarray) -> np.ndarray:
        """Adds each key once more; returns the keys that found no room."""
        prints, first, second = self.places(keys)
        failed = []
        for k, (p, a, b) in enumerate(zip(prints.tolist(), first.tolist(), second.tolist(), strict=True)):
            for at in (a, b):
                room = np.flatnonzero(self.slots[at] == 0)
                if len(room):
                    self.slots[at, room[0]] = p
                    break
            else:
                at, moved = a, []
                for step in range(200):  # push one out to its other bucket
                    slot = (step * 7 + p) % SLOTS
                    moved.append((at, slot))
                    p, self.slots[at, slot] = int(self.slots[at, slot]), p
                    at = int(self.other(np.array([at]), np.array([p], np.uint16))[0])
                    room = np.flatnonzero(self.slots[at] == 0)
                    if len(room):
                        self.slots[at, room[0]] = p
                        break
                else:
                    for at, slot in reversed(moved):
                        p, self.slots[at, slot] = int(self.slots[at, slot]), p
                    failed.append(k)
        return keys[failed]

    def delete(self, keys: np.ndarray) -> None:
        for p, a, b in zip(*(x.tolist() for x in self.places(keys)), strict=True):
            for at in (a, b):
                own = np.flatnonzero(self.slots[at] == p)
                if len(own):
                    self.slots[at, own[0]] = 0
                    break

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self.places(keys)
        return (self.slots[first] == prints[:, None]).any(1) | (self.slots[second] == prints[:, None]).any(1)


def key_of(line: str) -> bytes | None:
    """The digest of a line's key, or None where the key is too short."""
    line = line.strip(WHITE)
    return hashlib.blake2b(line.encode(errors="replace").lower(), digest_size=16).digest() if len(line) >= LEAST else None


def posted(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2: the distinct keys of each document."""

    def post(batches):
        released()
        for batch in batches:
            for part in slices(batch, 1):
                ids, keys = [], []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    own = {k for line in (text or "").split("\n") if (k := key_of(line))}
                    ids += [doc] * len(own)
                    keys += own
                k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy())], ["doc_id", "k1", "k2"])

    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(post, "doc_id long, k1 long, k2 long")


class LineIndex:
    """postings (doc_id, k1, k2), counts (k1, k2, n, first, last) and filters (shard, slots) as written tables."""

    def __init__(self, spark: SparkSession, postings: DataFrame, counts: DataFrame, filters: DataFrame, shards: int):
        self.spark, self.postings, self.counts, self.filters, self.shards = spark, postings, counts, filters, shards

    @staticmethod
    def counted(postings: DataFrame) -> DataFrame:
        return postings.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))

    @classmethod
    def built(cls, docs: DataFrame, shards: int | None = None) -> LineIndex:
        postings = written(posted(docs), "postings")
        counts = written(cls.counted(postings), "counts")
        shards = shards or max(8, min(4096, counts.where("first < last").count() // PER_SHARD + 1))
        index = cls(docs.sparkSession, postings, counts, None, shards)
        index.filters = written(index.updated(None, counts.where("first < last").select("k1", F.lit(1).alias("sign"))), "filters")
        return index

    def shard(self, column: str = "k1"):
        return F.pmod(F.xxhash64(column), F.lit(self.shards)).cast("int")

    def updated(self, filters: DataFrame | None, changes: DataFrame) -> DataFrame:
        """Filters after changes (k1, sign): 1 enters, -1 leaves. A filter without room is built anew at twice the size from its shard's shared keys."""
        rows = changes.select(self.shard().alias("shard"), "k1", "sign", F.lit(None).cast("binary").alias("slots"))
        if filters is not None:
            rows = rows.union(filters.select("shard", F.lit(None).cast("long"), F.lit(0), "slots"))

        def build(batches):
            shard, slots, keys = None, None, []

            def done():
                k = np.array(keys, np.int64).reshape(-1, 2)
                add, drop = k[k[:, 1] > 0, 0].view(np.uint64), k[k[:, 1] < 0, 0].view(np.uint64)
                own = CuckooFilter.loaded(slots) if slots else CuckooFilter.sized(len(add))
                own.delete(drop)
                full = len(own.insert(add)) > 0
                if full and not slots:
                    size = len(own.slots)
                    while full:
                        size *= 2
                        own = CuckooFilter(size)
                        full = len(own.insert(add)) > 0
                return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([None if full else own.dumped()], pa.binary())], ["shard", "slots"])

            for batch in batches:
                for s, k, sign, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if s != shard:
                        if shard is not None:
                            yield done()
                        shard, slots, keys = s, None, []
                    if raw is not None:
                        slots = raw
                    elif sign:
                        keys.append((k, sign))
            if shard is not None:
                yield done()

        return rows.repartition("shard").sortWithinPartitions("shard", "sign").mapInArrow(build, "shard int, slots binary")

    def moved(self, postings: DataFrame, counts: DataFrame) -> LineIndex:
        postings, counts = written(postings, "postings"), written(counts, "counts")
        was = self.counts.where("first < last").select("k1", "k2", F.lit(-1).alias("was"))
        now = counts.where("first < last").select("k1", "k2", F.lit(1).alias("now"))
        changes = was.join(now, ["k1", "k2"], "full_outer").select("k1", (F.coalesce("now", F.lit(0)) + F.coalesce("was", F.lit(0))).alias("sign")).where("sign <> 0")
        index = LineIndex(self.spark, postings, counts, None, self.shards)
        filters = written(self.updated(self.filters, changes), "filters")
        full = filters.where("slots is null").select("shard")
        if full.limit(1).count():
            anew = now.join(full, self.shard() == F.col("shard"), "left_semi").select("k1", F.lit(1).alias("sign"))
            filters = written(filters.where("slots is not null").union(self.updated(None, anew)), "filters")
        index.filters = filters
        return index

    def inserted(self, docs: DataFrame) -> LineIndex:
        """The index with documents that it does not hold yet."""
        new = written(posted(docs), "postings")
        counts = self.counts.union(self.counted(new)).groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
        return self.moved(self.postings.union(new), counts)

    def deleted(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of a table of doc_id; only their keys are counted anew."""
        gone, stay = self.postings.join(ids, "doc_id", "left_semi"), self.postings.join(ids, "doc_id", "left_anti")
        keys = gone.select("k1", "k2").distinct()
        counts = self.counts.join(keys, ["k1", "k2"], "left_anti").union(self.counted(stay.join(keys, ["k1", "k2"], "left_semi")))
        return self.moved(stay, counts)

    def dropped(self, postings: DataFrame | None = None) -> DataFrame:
        """doc_id, k1, k2 of lines that go: filter first, then the exact table, shard by shard."""
        postings = self.postings if postings is None else postings
        load = self.counts.groupBy(self.shard().alias("shard")).agg(F.ceil(F.sum("n") / PER_PART).cast("int").alias("parts"))  # at most self.shards rows
        load = F.broadcast(load)
        part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        none = F.lit(None)
        filters = self.filters.join(load, "shard").select("shard", part, F.lit(0).alias("kind"), none.cast("long").alias("doc_id"), none.cast("long").alias("k1"), none.cast("long").alias("k2"), "slots")
        exact = self.counts.where("first < last").withColumn("shard", self.shard()).join(load, "shard").select("shard", part, F.lit(1).alias("kind"), F.col("first").alias("doc_id"), "k1", "k2", none.cast("binary").alias("slots"))
        lines = postings.withColumn("shard", self.shard()).join(load, "shard").select("shard", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part"), F.lit(2).alias("kind"), "doc_id", "k1", "k2", none.cast("binary").alias("slots"))

        def decide(batches):
            own, known, at, pending = None, None, None, []
            for batch in batches:
                shard, part, kind, doc, k1, k2 = (batch.column(k).fill_null(0).to_numpy() for k in range(6))
                cuts = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])]))
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows], strict=True):
                    if (shard[a], part[a]) != at:
                        at, own, known, pending = (shard[a], part[a]), None, None, []
                    if kind[a] == 0:
                        own = CuckooFilter.loaded(batch.column(6)[a].as_py())
                    elif kind[a] == 1:
                        pending.append((k1[a:b], k2[a:b], doc[a:b]))
                    elif own is not None and pending:
                        if known is None:
                            known = [np.concatenate(x) for x in zip(*pending, strict=True)]
                            order = np.lexsort((known[1], known[0]))
                            known = [x[order] for x in known]
                        maybe = a + np.flatnonzero(own.contains(k1[a:b].view(np.uint64)))
                        i = np.searchsorted(known[0], k1[maybe])
                        go = np.zeros(len(maybe), bool)
                        for _ in range(4):  # keys that agree in their first half stand side by side
                            j = np.minimum(i, len(known[0]) - 1)
                            go |= (known[0][j] == k1[maybe]) & (known[1][j] == k2[maybe]) & (known[2][j] < doc[maybe])
                            i = i + 1
                        maybe = maybe[go]
                        yield pa.RecordBatch.from_arrays([pa.array(doc[maybe]), pa.array(k1[maybe]), pa.array(k2[maybe])], ["doc_id", "k1", "k2"])

        rows = filters.union(exact).union(lines).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind")
        return rows.mapInArrow(decide, "doc_id long, k1 long, k2 long")

    def rewritten(self, docs: DataFrame, names: tuple[str, str, str] = ("n_lines", "n_dropped", "kept_text")) -> DataFrame:
        """All columns of docs (doc_id, text) and the named ones: lines before, lines dropped, the text that stays."""
        gone = self.dropped().groupBy(F.col("doc_id").alias("gone_id__")).agg(F.collect_list(F.struct("k1", "k2")).alias("gone__"))
        columns = docs.columns
        rows = docs.join(gone, F.col("doc_id") == F.col("gone_id__"), "left").select(*columns, "gone__")
        at = columns.index("text")

        def rewrite(batches):
            released()
            for batch in batches:
                for part in slices(batch, at):
                    out = ([], [], [])
                    for text, keys in zip(part.column(at).to_pylist(), part.column(len(columns)).to_pylist(), strict=True):
                        lines = (text or "").split("\n")
                        kept = lines
                        if keys:
                            own = {np.array([k["k1"], k["k2"]], "<i8").tobytes() for k in keys}
                            kept = [line for line in lines if key_of(line) not in own]
                        for x, v in zip(out, (len(lines), len(lines) - len(kept), "\n".join(kept)), strict=True):
                            x.append(v)
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], [*columns, *names])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        return rows.mapInArrow(rewrite, f"{fields}, {names[0]} long, {names[1]} long, {names[2]} string")


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with text (and n_chars) as it is without repeated lines; other columns stay as they are."""
    own = LineIndex.built(docs).rewritten(docs, ("n_lines__", "n_dropped__", "kept__"))
    new = {"text": F.col("kept__"), "n_chars": F.length("kept__").cast("long")}
    return own.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    own = LineIndex.built(docs).rewritten(docs)
    return own.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


QUERIES["op2_line_dedup"] = op2_line_dedup
ORACLE["op2_line_dedup"] = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
j AS (SELECT k.*, coalesce(s.first < k.doc_id, false) AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
