"""Operator 11: nearest neighbours by a small-world graph per shard, shard results merged.

Equal vectors are one entry of the index, with as many of their smallest ids as a
query can ask for. Entries are dealt to shards of bounded size by a hash; each shard
becomes one row of flat arrays (ids, vectors, levels of neighbours), written as a
table. Every query visits every shard: a shard's row meets the queries as a stream,
in parts of bounded size. A shard gives the exact products of what its graph finds,
and the nearest of all shards stay.

Vectors that are null, zero, or hold a null or a component that is not finite take no
part, nor do rows without an id. Of several rows of an id the smallest vector counts.
Queries meet vectors of their own number of components only. Ties go to the smaller
id, own ids are left out, and with fewer candidates all are given. An empty table
gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import QUERIES, removed, table, written
from tidemark.llm.hnsw import BUILD, LINKS, Graph

NEAREST = 20
#: Entries of a shard on average, and queries that one task puts to a shard.
SHARD, PART = 8192, 50_000
#: Near vectors that a search of a shard holds.
WIDTH = 200
FOUND = "query_id long, vec_id long, score double"


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, v, dim: one usable vector of doubles for each id."""
    v = F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def entries(rows: DataFrame, most: int) -> DataFrame:
    """dim, v, ids: each different vector with up to most of its smallest ids."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return rows.withColumn("place", place).where(F.col("place") <= most).groupBy("dim", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def indexed(rows: DataFrame, most: int = NEAREST + 1, shard: int = SHARD, links: int = LINKS, build: int = BUILD) -> DataFrame:
    """The index as a written table: a row for each shard and number of components."""
    own = written(entries(rows, most), "entries")
    shards = max(1, -(-own.count() // shard))

    def grow(group: pa.Table) -> pa.Table:
        dim = group.column("dim")[0].as_py()
        group = group.combine_chunks()
        order = np.argsort([x[0] for x in group.column("ids").to_pylist()])
        group = group.take(pa.array(order))
        v = group.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        graph = Graph.built(v, links, build)
        group = group.take(pa.array(graph.order))  # rows in the graph's order of entry
        ids = group.column("ids").combine_chunks()
        counts = np.array([len(x) for x in ids.to_pylist()], "<i4")
        row = {
            "shard": group.column("shard")[0].as_py(),
            "dim": dim,
            "vectors": v[graph.order].astype("<f8").tobytes(),
            "counts": counts.tobytes(),
            "ids": ids.flatten().to_numpy().astype("<i8").tobytes(),
            "nodes": [x.astype("<i4").tobytes() for x in graph.nodes],
            "links": [x.astype("<i4").tobytes() for x in graph.links],
        }
        return pa.Table.from_pylist([row], schema=pa.schema([("shard", pa.int32()), ("dim", pa.int32()), ("vectors", pa.binary()), ("counts", pa.binary()), ("ids", pa.binary()), ("nodes", pa.list_(pa.binary())), ("links", pa.list_(pa.binary()))]))

    dealt = own.select(F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), "dim", "v", "ids")
    index = dealt.repartition(shards, "shard", "dim").groupBy("shard", "dim").applyInArrow(grow, "shard int, dim int, vectors binary, counts binary, ids binary, nodes array<binary>, links array<binary>")
    index = written(index, "index")
    removed(own)
    return index


class Shard:
    """A row of the index, ready to be searched."""

    def __init__(self, dim: int, vectors: bytes, counts: bytes, ids: bytes, nodes: list[bytes], links: list[bytes]):
        from tidemark.llm.hnsw import levelled

        self.vectors = np.frombuffer(vectors, "<f8").reshape(-1, dim)
        counts = np.frombuffer(counts, "<i4")
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.ids = np.frombuffer(ids, "<i8")
        nodes = [np.frombuffer(x, "<i4") for x in nodes]
        self.graph = Graph(levelled(self.vectors), nodes, [np.frombuffer(x, "<i4").reshape(len(own), -1) for own, x in zip(nodes, links, strict=True)])

    def nearest(self, own: np.ndarray, queries: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, ids found and products: up to k for each query, without its own id."""
        out = []
        for at in range(0, len(own), 256):
            q = queries[at : at + 256]
            for me, one, places in zip(own[at : at + 256].tolist(), q, self.graph.search(q, width), strict=True):
                places = places[places >= 0]
                score = (self.vectors[places] * one).sum(1)
                if len(places) > k + 1:  # with ties; an entry's first ids rank before those of lower products
                    worst = np.partition(score, -(k + 1))[-(k + 1)]
                    places, score = places[score >= worst], score[score >= worst]
                many = self.first[places + 1] - self.first[places]
                ids = np.concatenate([self.ids[self.first[p] : self.first[p + 1]] for p in places.tolist()])
                score = np.repeat(score, many)
                ids, score = ids[ids != me], score[ids != me]
                best = np.lexsort((ids, -score))[:k]
                out.append((np.full(len(best), me), ids[best], score[best]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def searched(index: DataFrame, queries: DataFrame, k: int = NEAREST, width: int = WIDTH) -> DataFrame:
    """query_id, rank, vec_id, score for queries (vec_id, v, dim) over all shards of the index."""
    parts = max(1, -(-queries.count() // PART))
    none = F.lit(None)
    head = index.columns[2:]
    kinds = dict(index.dtypes)
    empty: list[Column] = [none.cast(kinds[c]).alias(c) for c in head]
    graphs = index.select("shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "dim", F.lit(0).alias("kind"), none.cast("long").alias("query_id"), none.cast("array<double>").alias("v"), *head)
    at = index.select("dim", "shard").groupBy("dim").agg(F.collect_list("shard").alias("shards"))  # a number for each shard
    asked = queries.join(F.broadcast(at), "dim").select(F.explode("shards").alias("shard"), F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), "dim", F.lit(1).alias("kind"), F.col("vec_id").alias("query_id"), "v", *empty)

    def answer(batches):
        shard, at = None, None
        for batch in batches:
            where = list(zip(*(batch.column(c).to_pylist() for c in ("shard", "part", "dim", "kind")), strict=True))
            cuts = [0, *(i for i in range(1, len(where)) if where[i] != where[i - 1]), len(where)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if where[a][3] == 0:
                    shard, at = Shard(where[a][2], *(batch.column(c)[a].as_py() for c in head)), where[a][:3]
                elif where[a][:3] == at:
                    for low in range(a, b, 1024):
                        part = batch.slice(low, min(b, low + 1024) - low)
                        q = part.column("v").flatten().to_numpy().reshape(part.num_rows, -1)
                        got = shard.nearest(part.column("query_id").to_numpy(), q, k, width)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], ["query_id", "vec_id", "score"])

    # As many tasks as shards: a batch of rows holds few shards' arrays.
    found = graphs.union(asked).repartition(max(1, index.count()) * parts, "shard", "part", "dim").sortWithinPartitions("shard", "part", "dim", "kind").mapInArrow(answer, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(usable(table(spark, sf_dir, "embeddings")), "vectors")
    return searched(indexed(rows), rows.where("vec_id % 20 = 0"))


QUERIES["op11_nearest_neighbours"] = op11_nearest_neighbours
