"""Operator 8: n-gram Jaccard join with count-vector bounds.

A document's set holds its distinct 5-word shingles as 64-bit hashes. Equal sets are
one node (128-bit digest and size). The hashes fall into groups (512, of long texts
4096); a node's counts by group are a point, and the sum of coordinate minima of two
points bounds their overlap, which links must have at 3/7 of both sizes together.

Candidates meet in buckets: a set's rarest quarter of shingles, in an order all sets
share (frequent shingles last; the order only steers the work, any order loses no
link). What follows a shingle in that order bounds the overlap of two sets that have
it as their first in common, so a bucket holds only pairs whose rests are long enough.
In each bucket every member is first held against the one of smallest digest, which
many buckets of a group of near copies have in common. Links found so are verified on
the whole sets and give first components. Buckets with members still apart are named
by their members, so that those with the same members (shingles of one passage) count
once; one more pivot follows, and what is still apart is searched by an R-tree over the
points: its nodes hold coordinate maxima, and whatever the bound rules out, by size or
by minima, is left out. A first search takes surviving pairs for links as it goes and so
gives a forest, which is verified; the second gives all surviving pairs of the components
that are then left, which are verified too.
Pairs within a component need no test, as they can't change the result; so a group of
near copies takes work in proportion to its size.

Hashes: two different shingles of one pair of sets may agree in 64 bits, which can
change a count by one; for sets of 10,000 that has odds of about 1e-11 a pair.

Rows with null ids take part in nothing and have component null; an id names one text. Null texts and texts
without words have empty sets and are alone. Repeated rows are copies. Other columns
of the input are not read, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import QUERIES, mix64, released, removed, slices, table, written
from tidemark.llm.graph import components

WIDTH = 5
GROUPS = 512
#: Groups of sets with LONG shingles or more; counts of the finer groups add up to those of the coarser.
FINE, LONG = 4096, 3000
COARSE = 256
#: Shingles known to be frequent, at most; they are ordered last. It bounds a broadcast and changes no result.
FREQUENT = 1 << 19
OFTEN = 4
#: Members of a bucket held against each other in one go; larger buckets are dealt in blocks.
BLOCK = 2048
#: Ids that are sent to all executors, at most (16 bytes each); more are shuffled.
SENT = 1 << 21
#: Bytes of text that are hashed at once; longer texts are cut between words.
STRETCH = 1_000_000

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_gap = np.zeros(256, bool)
_gap[[32, 9, 10, 11, 12, 13]] = True
_words_end = re.compile(rb"[ \t-\r]*[^ \t-\r]*")
_M = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        n = max(n, 1 << 16)
        for name, x in (("up", _M), ("down", pow(_M, -1, 1 << 64))):
            p = np.full(n, x, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def stretches(raw: bytes) -> list[bytes]:
    """A long text as parts that have all its shingles: each ends with the four words that the next starts with."""
    if len(raw) <= 2 * STRETCH:
        return [raw]
    out, at = [], 0
    while at < len(raw):
        end, last = min(at + STRETCH, len(raw)), at
        if end < len(raw):  # on to the end of a word, and four more words
            for k in range(WIDTH):
                got = _words_end.search(raw, end)
                end = got.end() if got else len(raw)
                last = end if not k else last
        out.append(raw[at:end])
        at = last if end < len(raw) else end
    return out


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    parts = [stretches((t or "").encode(errors="replace")) for t in texts]
    if all(len(p) == 1 for p in parts):
        return hashed([p[0] for p in parts])
    out = []
    for p in parts:
        own = [hashed([x])[0] for x in p]
        out.append(own[0] if len(own) == 1 else np.unique(np.concatenate(own)))
    return out


def hashed(raw: list[bytes]) -> list[np.ndarray]:
    joined = _lower[np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)]
    starts = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    word = ~_gap[joined]
    first = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    end = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    up, down = _power(len(joined) + 1)
    total = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(joined.astype(np.uint64) * up[: len(joined)], out=total[1:])
    h = mix64((total[end] - total[first]) * down[first] + (end - first).astype(np.uint64))
    odd = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
    n = len(h)
    five = np.zeros(max(n - WIDTH + 1, 0), np.uint64)
    for k in range(WIDTH):
        five += h[k : n - WIDTH + 1 + k] * odd[k] if len(five) else five
    five = mix64(five)
    at = np.searchsorted(first, starts)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= WIDTH:
            out.append(np.unique(five[a : b - WIDTH + 1]))
        elif b > a:
            out.append(mix64(np.array([int((h[a:b] * odd[: b - a]).sum()) + (b - a) & (1 << 64) - 1], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(s: np.ndarray, odd: int = 0x51ED270B0A1F39C1) -> int:
    return int((mix64(s ^ np.uint64(odd))).sum(dtype=np.uint64).astype(np.int64))


def counts(s: np.ndarray) -> np.ndarray:
    return np.bincount((s >> np.uint64(52 if len(s) >= LONG else 55)).astype(np.intp), minlength=FINE if len(s) >= LONG else GROUPS)


def stored(n: np.ndarray) -> bytes:
    """Counts in as many bytes as the largest needs, which is said in front."""
    kind = "<u1" if n.max() < 1 << 8 else "<u2" if n.max() < 1 << 16 else "<u4"
    return kind[2].encode() + n.astype(kind).tobytes()


def point(raw: bytes, groups: int) -> np.ndarray:
    """Counts of as many groups, which are no more than are stored."""
    own = np.frombuffer(raw, f"<u{raw[:1].decode()}", offset=1).astype(np.int32)
    return own if len(own) == groups else own.reshape(groups, -1).sum(1)


def minima(a: list[bytes], b: list[bytes], na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The bound on the overlap of each pair."""
    fine = np.minimum(na, nb) >= LONG
    out = np.zeros(len(na), np.int64)
    for groups, at in ((GROUPS, np.flatnonzero(~fine)), (FINE, np.flatnonzero(fine))):
        for k in range(0, len(at), 256):
            part = at[k : k + 256].tolist()
            out[part] = np.minimum(np.stack([point(a[i], groups) for i in part]), np.stack([point(b[i], groups) for i in part])).sum(1)
    return out


def needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least overlap of linked sets: 100 * overlap >= 75 * union."""
    return -(-3 * (n + m) // 7)


class CountTree:
    """An R-tree over points of group counts, packed by size; its nodes hold coordinate maxima and bounds of size."""

    def __init__(self, p: np.ndarray, n: np.ndarray, fan: int = 32):
        self.order = np.argsort(n, kind="stable")
        self.p, self.n, self.fan = p[self.order], n[self.order], fan
        self.levels = []
        high, low, top = self.p, self.n, self.n
        while len(high) > 1:
            cuts = np.arange(0, len(high), fan)
            high, low, top = np.maximum.reduceat(high, cuts, 0), np.minimum.reduceat(low, cuts), np.maximum.reduceat(top, cuts)
            self.levels.append((high, low, top))

    def near(self, q: np.ndarray, m: int) -> np.ndarray:
        """Rows whose size and minima allow a link with a set of m shingles and counts q."""
        if not self.levels:
            at = np.arange(len(self.p))
        else:
            at = np.arange(len(self.levels[-1][0]))
            for k in range(len(self.levels) - 1, -1, -1):
                high, low, top = (x[at] for x in self.levels[k])
                at = at[(4 * top >= 3 * m) & (3 * low <= 4 * m) & (np.minimum(high, q).sum(1) >= needed(low, m))]
                below = len(self.levels[k - 1][0]) if k else len(self.p)
                at = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
                at = at[at < below]
        n = self.n[at]
        at = at[(4 * n >= 3 * m) & (3 * n <= 4 * m) & (np.minimum(self.p[at], q).sum(1) >= needed(n, m))]
        return self.order[at]


def scanned(docs: DataFrame) -> DataFrame:
    """Rows of kind 0: doc_id, d and e (digest), n and counts of every document; of kind 1: shingles (d) that a stretch of texts holds OFTEN times or more (n)."""
    names = ["doc_id", "d", "e", "n", "counts", "kind"]

    def flush(sets):
        if sets:
            s, n = np.unique(np.concatenate(sets), return_counts=True)
            often = n >= OFTEN
            s, n = s[often].view(np.int64), n[often]
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(s), pa.int64()), pa.array(s), pa.nulls(len(s), pa.int64()), pa.array(n), pa.nulls(len(s), pa.binary()), pa.array(np.ones(len(s), np.int32))], names)

    def scan(batches):
        released()
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, 1, STRETCH):
                sets = shingle_sets(part.column(1).to_pylist())
                both = [pa.array([digest(s, k) for s in sets], pa.int64()) for k in (0x51ED270B0A1F39C1, 0x2545F4914F6CDD1D)]
                yield pa.RecordBatch.from_arrays([part.column(0), *both, pa.array([len(s) for s in sets], pa.int64()), pa.array([stored(counts(s)) for s in sets], pa.binary()), pa.array(np.zeros(len(sets), np.int32))], names)
                held += sets
                size += sum(map(len, sets))
                if size > 3_000_000:
                    yield from flush(held)
                    held, size = [], 0
        yield from flush(held)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, "doc_id long, d long, e long, n long, counts binary, kind int")


def postings(docs: DataFrame, frequent: pa.Table, hot: int = 20_000) -> DataFrame:
    """slot, d, size: the prefix of each set; frequent: shingles and times, at most FREQUENT rows.

    A slot is a shingle; of one seen hot times or more, a part of its sets. A size holds the part, the set's size and
    in how many sixteenths of the prefix the shingle stands, in one number, as most of what is shuffled are these rows.
    """
    keys, times = frequent.column("key").to_numpy().view(np.uint64), frequent.column("times").to_numpy()
    order = np.argsort(keys)
    sent = docs.sparkSession.sparkContext.broadcast((keys[order], times[order]))

    def emit(batches):
        keys, often = sent.value
        seen: set[tuple[int, int, int]] = set()
        for batch in batches:
            for part in slices(batch, 0, STRETCH):
                out = ([], [], [])
                for s in shingle_sets(part.column(0).to_pylist()):
                    n = len(s)
                    if not n or (own := (digest(s), digest(s, 0x2545F4914F6CDD1D), n)) in seen:
                        continue
                    if len(seen) < 100_000:
                        seen.add(own)
                    times = np.zeros(n, np.int64)
                    if len(keys):
                        at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                        times = np.where(keys[at] == s, often[at], 0)
                    prefix = n - -(-3 * n // 4) + 1
                    rank = np.lexsort((s, times))[:prefix] if times.any() else np.arange(prefix)
                    parts = np.minimum(times[rank] // hot, (1 << 20) - 1)
                    parts = np.where(parts > 0, 1 + (own[0] & 0x7FFFFFFF) % (parts + 1), 0)
                    out[0].append(s[rank].view(np.int64) ^ parts << 40)
                    out[1].append(np.full(prefix, own[0], np.int64))
                    out[2].append((parts << 32 | n) << 4 | np.arange(prefix) * 16 // prefix)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["slot", "d", "size"])

    return docs.select(F.col("text").cast("string")).mapInArrow(emit, "slot long, d long, size long")


#: Of a bucket's pairs, those whose sizes and rests allow a link.
NEAR = "4 * {0}n >= 3 * {1}n and 4 * {1}n >= 3 * {0}n and 7 * least({0}left, {1}left) >= 3 * ({0}n + {1}n)"


def narrowed(rows: DataFrame, pairs: DataFrame, column: str = "id") -> DataFrame:
    """The rows whose id a written table of pairs (a, b) names."""
    ids = pairs.select(F.col("a").alias(column)).union(pairs.select("b")).distinct()
    few = pairs.count() <= SENT // 2
    return rows.join(F.broadcast(ids) if few else ids, column, "left_semi")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """a, b of the given pairs (a, b: ids of nodes) that are linked; whole texts are dealt by b, many pairs of one b in parts."""
    pairs = written(pairs, "pairs")
    texts = narrowed(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")), pairs)
    texts = written(texts.dropDuplicates(["id"]), "texts")
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / 1000).cast("int").alias("parts"))
    left = pairs.join(parts, "b").select("b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"), "a").join(texts.withColumnRenamed("id", "a"), "a")
    right = parts.join(texts.withColumnRenamed("id", "b"), "b").select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("a"), "text")

    def verify(batches):
        own, base = None, None
        for batch in batches:
            for part in slices(batch, 4, STRETCH):
                b, kind, a = (part.column(k).to_pylist() for k in (0, 2, 3))
                out = ([], [])
                for x, k, y, s in zip(b, kind, a, shingle_sets(part.column(4).to_pylist()), strict=True):
                    if not k:
                        own, base = x, s
                    elif x == own and 7 * len(np.intersect1d(base, s, True)) >= 3 * (len(base) + len(s)):
                        out[0].append(y)
                        out[1].append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])

    both = left.select("b", "part", "kind", "a", "text").union(right.select("b", "part", "kind", "a", "text"))
    links = written(both.repartition("b", "part").sortWithinPartitions("b", "part", "kind").mapInArrow(verify, "a long, b long"), "links")
    removed(pairs, texts)
    return links


def bounded(pairs: DataFrame, counted: DataFrame) -> DataFrame:
    """Of a written table of pairs (a, b), those that sizes and minima of counts allow."""
    own = narrowed(counted, pairs)
    x = own.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca"))
    y = own.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb"))

    def bound(batches):
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(k).to_numpy() for k in (2, 4))
                ok = minima(batch.column(3).to_pylist(), batch.column(5).to_pylist(), na, nb) >= needed(na, nb)
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], ["a", "b"])

    sized = pairs.join(x, "a").join(y, "b").where("4 * na >= 3 * nb and 4 * nb >= 3 * na")
    return sized.select("a", "b", "na", "ca", "nb", "cb").mapInArrow(bound, "a long, b long")


def placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members with their components so far; of buckets whose members are apart."""
    own = members.join(found.select(F.col("node").alias("id"), "component"), "id", "left")
    own = own.select("key", "id", "n", "left", F.coalesce("component", "id").alias("component"))
    apart = own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    return own.join(apart, "key", "left_semi")


def pivoted(members: DataFrame, salt: int) -> DataFrame:
    """a, b: each bucket's members against its first in another order, where the components differ and the bucket allows a link."""
    first = members.groupBy("key").agg(F.min(F.struct(F.xxhash64(F.lit(salt), "id").alias("h"), "id", "n", "left", "component")).alias("p"))
    pairs = members.join(first, "key").where("component <> p.component and " + NEAR.format("", "p."))
    return pairs.select(F.greatest("id", "p.id").alias("a"), F.least("id", "p.id").alias("b")).distinct()


def by_members(rows: DataFrame) -> DataFrame:
    """key, d, n, left: of buckets (key, d, n, left, open) with an open row and the same members one, in which each has the longest of its rests."""
    names = rows.groupBy("key").agg(*(F.bit_xor(F.xxhash64(F.lit(k), "d", "n")).alias(f"name{k}") for k in (1, 2)), F.count("*").alias("m"), F.max("open").alias("open")).where("m > 1 and open")
    named = rows.drop("open").join(names, "key")
    return named.groupBy("name1", "name2", "m", "d", "n").agg(F.max("left").alias("left")).select(F.struct("name1", "name2", "m").alias("key"), "d", "n", "left")


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("k1", "k2", "i", "j").sortWithinPartitions("k1", "k2", "i", "j")


def by_bucket(batches, compute):
    """compute(rows of a bucket's pair of blocks) for one after the other."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[:4] != held[0][:4]:
                yield compute(held)
                held = []
            held.append(row)
    if held:
        yield compute(held)


MEMBER = "k1 long, k2 long, i int, j int, id long, n long, left long, component long, block int"


def paired(members: DataFrame) -> DataFrame:
    """MEMBER: the members (key, id, n, left, component) that have a partner in another component by size and rest; large buckets are dealt in pairs of blocks."""
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = members.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select(F.col("key.name1").alias("k1"), F.col("key.name2").alias("k2"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "n", "left", "component", "block")
    schema = pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.int32()) for f in MEMBER.split(", ")])

    def partners(held):
        n, left, comp, block = (np.array([r[k] for r in held]) for k in (5, 6, 7, 8))
        i, j = held[0][2:4]
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        has = np.zeros(len(held), bool)
        for k in range(0, len(a), 256):
            x = a[k : k + 256, None]
            ok = (comp[x] != comp[b]) & (4 * n[x] >= 3 * n[b]) & (4 * n[b] >= 3 * n[x]) & (np.minimum(left[x], left[b]) >= needed(n[x], n[b]))
            has[a[k : k + 256]] |= ok.any(1)
            has[b] |= ok.any(0)
        rows = [r for r, h in zip(held, has.tolist(), strict=True) if h]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)

    return dealt(own).mapInArrow(lambda batches: by_bucket(batches, partners), MEMBER)


def still_apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """MEMBER with components as they are now, of buckets with several."""
    columns = members.columns
    own = members.drop("component").join(found.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    at = ["k1", "k2", "i", "j"]
    return own.join(own.groupBy(*at).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select(*at), at, "left_semi").select(*columns)


def searched(members: DataFrame, forest: bool) -> DataFrame:
    """a, b of different components that the R-trees of the buckets allow; members: MEMBER and counts. As a forest: one pair of two components, which count as one from there on."""

    def pairs(held):
        ids, n, left, comp, block = (np.array([r[k] for r in held]) for k in (4, 5, 6, 7, 8))
        vectors = [r[9] for r in held]
        p = np.stack([point(v, COARSE) for v in vectors])
        i, j = held[0][2:4]
        asked, tree_rows = np.flatnonzero(block == i), np.flatnonzero(block == j)
        tree = CountTree(p[tree_rows], n[tree_rows])
        a, b = [], []
        for q in asked.tolist():
            near = tree_rows[tree.near(p[q], int(n[q]))]
            near = near[(comp[near] != comp[q]) & (np.minimum(left[near], left[q]) >= needed(n[near], n[q])) & ((ids[near] > ids[q]) if i == j else True)]
            if len(near):
                overlap = minima([vectors[q]] * len(near), [vectors[k] for k in near.tolist()], np.full(len(near), n[q]), n[near])
                near = near[overlap >= needed(n[near], n[q])]
            if forest and len(near):
                others, first = np.unique(comp[near], return_index=True)
                near = near[first]
                comp[np.isin(comp, others)] = comp[q]
            a += [int(ids[q])] * len(near)
            b += ids[near].tolist()
        x, y = np.array(a, np.int64), np.array(b, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], ["a", "b"])

    def search(batches):
        return by_bucket(batches, pairs)

    return dealt(members).mapInArrow(search, "a long, b long").distinct()


def linked(docs: DataFrame, hot: int = 20_000) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row; keys seen hot times or more are dealt in parts, which changes no result."""
    both = written(scanned(docs), "scan")
    rows = both.where("kind = 0").select("doc_id", "d", "e", "n", "counts")
    often = both.where("kind = 1").groupBy(F.col("d").alias("key")).agg(F.sum("n").alias("times"))
    frequent = often.orderBy(F.desc("times"), "key").limit(FREQUENT).toArrow()
    nodes = written(rows.where("n > 0 and doc_id is not null").groupBy("d", "e", "n").agg(F.min("doc_id").alias("id")), "nodes")
    counted = rows.where("doc_id is not null").select(F.col("doc_id").alias("id"), "n", "counts")
    ids = nodes.select("d", "n", "id")
    in_order = Window.partitionBy("slot").orderBy("d", "size").rowsBetween(Window.unboundedPreceding, 0)
    ordered = Window.partitionBy("slot").orderBy("d", "size")
    stars = postings(docs.where("doc_id is not null"), frequent, hot).withColumn("pivot", F.first(F.struct("d", "size")).over(in_order)).withColumn("last", F.lag(F.struct("d", "size")).over(ordered))
    same = "d = {0}.d and shiftright(size, 4) = shiftright({0}.size, 4)"  # copies of a set from several tasks
    stars = stars.where(f"not ({same.format('pivot')} and size < 1L << 36) and (last is null or not ({same.format('last')}))")
    part = F.shiftright("size", 36)
    columns = [F.col("slot").bitwiseXOR(F.shiftleft(part, 40)).alias("key"), part.alias("part")]
    for name, row in (("", ""), ("p", "pivot.")):
        n = F.shiftright(row + "size", 4).bitwiseAND((1 << 32) - 1)
        left = n - F.expr(f"(({row}size & 15) * (n_ - ceil(3 * n_ / 4) + 1)) div 16".replace("n_", f"(shiftright({row}size, 4) & 4294967295L)"))
        columns += [F.col(row + "d").alias(name + "d"), n.alias(name + "n"), left.alias(name + "left")]
    stars = starred = written(stars.select(*columns), "stars")
    # Keys dealt in parts: the parts' first members are held against the first of all.
    tops = stars.where("part > 0").groupBy("key").agg(F.min(F.struct("pd", "pn", "pleft")).alias("top"))
    across = stars.where("part > 0").select("key", "pd", "pn", "pleft").distinct().join(tops, "key").select("key", F.col("pd").alias("d"), F.col("pn").alias("n"), F.col("pleft").alias("left"), F.col("top.pd").alias("pd"), F.col("top.pn").alias("pn"), F.col("top.pleft").alias("pleft"))
    stars = stars.drop("part").union(across).where("d <> pd or n <> pn")
    named = stars.where(NEAR.format("", "p")).select("d", "n", "pd", "pn").distinct().join(ids.withColumnRenamed("id", "a"), ["d", "n"]).join(ids.select(F.col("d").alias("pd"), F.col("n").alias("pn"), F.col("id").alias("b")), ["pd", "pn"])
    tried = written(named, "tried")
    tested = tried.select("a", "b")
    links = verified(bounded(tested, counted), docs)
    # Nodes that differ in the second half of the digest only have met nowhere.
    twins = ids.join(ids.groupBy("d", "n").count().where("count > 1"), ["d", "n"], "left_semi")
    twins = twins.join(twins.withColumnRenamed("id", "b"), ["d", "n"]).where("id > b").select(F.col("id").alias("a"), "b")
    links = links.union(verified(twins, docs))
    found = components(links)
    # Buckets with a member that is not linked to the first, and more than that pair.
    near = written(tried.join(links, ["a", "b"], "left_semi").select("d", "n", "pd", "pn", F.lit(False).alias("near")), "near")
    near = F.broadcast(near) if near.count() <= SENT // 2 else near
    # The first of all parts has met its own part and the pivots only, so it is a member like the others.
    more = stars.join(near, ["d", "n", "pd", "pn"], "left").select("key", "d", "n", "left", F.coalesce("near", F.lit(True)).alias("open"))
    more = more.union(tops.select("key", "top.pd", "top.pn", "top.pleft", F.lit(False)))
    members = written(by_members(more).join(ids, ["d", "n"]).select("key", "id", "n", "left"), "members")
    removed(starred)
    own = written(placed(members, found), "members")
    pairs = written(pivoted(own, 0).join(tested, ["a", "b"], "left_anti"), "tried")
    links = links.union(verified(bounded(pairs, counted), docs))
    tested, found = tested.union(pairs), components(links)
    held = [members, own, tried, pairs]
    members = written(paired(placed(own.drop("component"), found)), "members")
    points = written(narrowed(counted.select("id", "counts"), members.select(F.col("id").alias("a"), F.col("id").alias("b"))), "points")
    for forest in (True, False):
        own = still_apart(members, found)
        pairs = written(searched(own.join(points, "id").select(*own.columns, "counts"), forest).join(tested, ["a", "b"], "left_anti"), "searched")
        new = verified(pairs, docs)
        held += [pairs]
        if new.limit(1).count():
            links, tested = links.union(new), tested.union(pairs)
            found = components(links)
    removed(*held, members, points)
    whole = nodes.select("d", "e", "n", "id").join(found.select(F.col("node").alias("id"), "component"), "id", "left").select("d", "e", "n", F.coalesce("component", "id").alias("component"))
    return rows.drop("counts").join(whole, ["d", "e", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each component the row with the smallest doc_id; the columns stay as they are. Rows with null ids stay."""
    found = linked(docs)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"))


QUERIES["op8_ngram_jaccard_join"] = op8_ngram_jaccard_join
