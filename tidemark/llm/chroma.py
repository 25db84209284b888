"""Operator 1: chroma fingerprints of media columns, and their alignment.

A recording is a column of 8-bit PCM bytes. Frames are transformed and their energy
folded into twelve pitch classes; the integral image of pitch classes over time gives
any rectangle's sum in four reads. Sixteen filters compare rectangles and each answers
with two bits, which make one 32-bit integer for each window of frames.

Recordings with the same integers form a class. Queries are classes that hold an id
divisible by EVERY. A query and a class align if at one offset a run of windows, half as
many as the shorter of both has (LEAST at least, or all of a shorter one), differs in
less than LIMIT of its bits; the least bit error of such a run is reported. Queries are
also fingerprinted from every STEP-th sample of the first hop on, as shifts need not be
multiples of a hop. With a mean below 1.5 bits an integer, more than a quarter of such a
run's windows differ in one bit at most: so the candidates are the offsets at which that
many integers meet a query's integers or these with one bit turned, and none is lost.
Blocks of queries meet parts of all recordings in tasks of their own, where hits are
counted and summed up by query: work grows with queries times recordings, as a search of
all rows for a share of them does, but no hit and no pair is shuffled.

A window needs WHOLE bytes. Shorter media are repeated up to it, one window for each
hop that holds samples, so they have a class and alignments too; n_windows counts whole
windows (0 for them) and n_integers all integers. Null or empty media give no integers:
such rows are alone in their class. Repeated rows are of one class. Other columns are
not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import QUERIES, slices, table, written

RATE, FRAME, HOP, SPAN = 8000, 512, 256, 8
EVERY = 50
#: Samples of a whole window.
WHOLE = FRAME + (SPAN - 1) * HOP
#: Filters (kind, first pitch class, classes, first frame, frames): fixed values of this operator.
FILTERS = [(k, (5 * i) % 12, 1 + i % 4, i % 3, 3 + i % 6) for i, k in enumerate((0, 1, 2, 3) * 4)]
LIMITS = (-0.12, 0.0, 0.12)
#: Bit error of an alignment (the candidates' count of hits follows from it), windows it needs, samples between a query's starts.
LIMIT, LEAST, STEP = 1.5 / 32, 4, 32
#: Integers of a block of queries and of a part of the recordings, parts at least, hits counted at a time. They bound memory and change no result.
POINTS, INTEGERS, PARTS, HITS = 2_000_000, 2_000_000, 64, 500_000
_bins = np.arange(1, FRAME // 2)
_class = np.round(12 * np.log2(_bins * RATE / FRAME / 440)).astype(int) % 12
_fold = np.zeros((FRAME // 2 - 1, 12), np.float32)
_fold[np.arange(len(_class)), _class] = 1
_window = np.hanning(FRAME).astype(np.float32)


def chroma(samples: np.ndarray) -> np.ndarray:
    """Pitch-class energies by frame, each frame of unit length."""
    if len(samples) < FRAME:
        return np.zeros((0, 12), np.float32)
    frames = np.lib.stride_tricks.sliding_window_view(samples.astype(np.float32) - 128, FRAME)[::HOP]
    energy = np.abs(np.fft.rfft(frames * _window, axis=1)[:, 1 : FRAME // 2]) ** 2
    c = energy.astype(np.float32) @ _fold
    return c / (np.linalg.norm(c, axis=1, keepdims=True) + 1e-6)


def fingerprint(samples: np.ndarray) -> np.ndarray:
    """One integer for each window of SPAN frames; of short media for each hop that holds samples."""
    if 0 < len(samples) < WHOLE:
        samples = np.pad(samples, (0, WHOLE + (len(samples) - 1) // HOP * HOP - len(samples)), mode="wrap")
    c = chroma(samples)
    n = len(c) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(c) + 1, 13))
    image[1:, 1:] = c.cumsum(0).cumsum(1)
    at = np.arange(n)

    def area(t, frames, p, classes):
        p2 = min(12, p + classes)
        return image[at + t + frames, p2] - image[at + t, p2] - image[at + t + frames, p] + image[at + t, p]

    out = np.zeros(n, np.uint32)
    for kind, p, classes, t, frames in FILTERS:
        p, frames = min(p, 12 - classes), min(frames, SPAN - t)
        half, mid = max(1, frames // 2), max(1, classes // 2)
        if kind == 0:
            a, b = area(t, frames, p, classes), area(t, frames, 0, 12) * classes / 12
        elif kind == 1:
            a, b = area(t, half, p, classes), area(t + frames - half, half, p, classes)
        elif kind == 2:
            a, b = area(t, frames, p, mid), area(t, frames, min(11, p + mid), mid)
        else:
            a, b = area(t, half, p, mid) + area(t + frames - half, half, min(11, p + mid), mid), area(t, half, min(11, p + mid), mid) + area(t + frames - half, half, p, mid)
        level = np.searchsorted(LIMITS, np.round(np.log((a + 0.05) / (b + 0.05)), 6))
        gray = level ^ (level >> 1)
        out = (out << np.uint32(2)) | gray.astype(np.uint32)
    return out


def fingerprinted(media: DataFrame, id_column: str, column: str, every: int = EVERY) -> DataFrame:
    """id, n_windows (whole ones), n_integers, fingerprint (array of integers), crc, shifted (of queries: fingerprints from each start)."""

    def compute(batches):
        for batch in batches:
            for part in slices(batch, 1):
                ids = part.column(0).to_pylist()
                media = [np.frombuffer(x or b"", np.uint8) for x in part.column(1).to_pylist()]
                got = [fingerprint(x) for x in media]
                shifted = [None if i is None or i % every or not len(x) else [fingerprint(x[k:]).astype(np.int64) for k in range(0, min(HOP, len(x)), STEP)] for i, x in zip(ids, media, strict=True)]
                whole = [len(g) if len(x) >= WHOLE else 0 for x, g in zip(media, got, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(whole, pa.int64()), pa.array([len(x) for x in got], pa.int64()), pa.array([x.astype(np.int64) for x in got], pa.list_(pa.int64())), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in got], pa.int64()), pa.array(shifted, pa.list_(pa.list_(pa.int64())))], ["id", "n_windows", "n_integers", "fingerprint", "crc", "shifted"])

    return media.select(F.col(id_column).cast("long"), F.col(column).cast("binary")).mapInArrow(compute, "id long, n_windows long, n_integers long, fingerprint array<long>, crc long, shifted array<array<long>>")


def run_of(short):
    """Windows of an alignment: half of the shorter recording's, LEAST or all of it at least."""
    return np.maximum(np.minimum(LEAST, short), -(-short // 2))


def ragged(counts: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n of counts, one after the other."""
    ends = counts.cumsum()
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def spans(counts: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Stretches of counts (above 0) with a sum of about most, or of one count."""
    cuts = [*np.unique(np.searchsorted(counts.cumsum(), np.arange(0, int(counts.sum()), most), "right")).tolist(), len(counts)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def flat(lists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All integers of an Arrow list column, where each list begins, and how many it has."""
    n = np.array([len(x) for x in lists], np.int64)
    values = np.concatenate([np.asarray(x, np.int64) for x in lists]).astype(np.uint32) if n.sum() else np.zeros(0, np.uint32)
    return values, n.cumsum() - n, n


class Search:
    """A block of queries, from each start, held against other recordings a few at a time."""

    def __init__(self, queries: np.ndarray, prints: list):
        """queries: the class of each start; prints: its integers."""
        self.queries, (self.a, self.begin, self.na) = queries, flat(prints)
        start, at = np.repeat(np.arange(len(self.na)), self.na), ragged(self.na)
        keys = (self.a.astype(np.uint64) << np.uint64(31)) + start.astype(np.uint64)
        order = keys.argsort(kind="stable")
        self.keys, self.start, self.at = keys[order], start[order], at[order]

    def near(self, values: np.ndarray, first: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in values, place in the index, number): what differs in one bit at most and is of the starts from first to end."""
        turned = np.array([0, *(1 << k for k in range(32))], np.uint32)
        distinct, back = np.unique(values, return_inverse=True)
        found = []
        for k in range(0, len(distinct), 1 << 15):
            wanted = (distinct[k : k + (1 << 15), None] ^ turned).astype(np.uint64) << np.uint64(31)
            low, high = (np.searchsorted(self.keys, wanted + np.uint64(x)) for x in (first, end))
            row, bit = np.nonzero(high > low)
            found.append((row + k, low[row, bit], (high - low)[row, bit]))
        row, low, n = (np.concatenate(x) for x in zip(*found, strict=True))
        each = np.bincount(row, minlength=len(distinct))  # rows come in order, so those of one value stand together
        own = each[back]
        take = np.repeat((each.cumsum() - each)[back], own) + ragged(own)
        return np.repeat(np.arange(len(values)), own), low[take], n[take]

    def peaks(self, ids, b, begin, nb, c0: int, c1: int):
        """Rows (query, other, offset, matches, bit error) of the recordings from c0 to c1, all of a recording in one yield."""
        todo, rows = [(0, len(self.na))], []
        values = b[begin[c0] : begin[c1 - 1] + nb[c1 - 1]]
        of, pos = np.repeat(np.arange(c0, c1), nb[c0:c1]), ragged(nb[c0:c1])
        while todo:
            first, end = todo.pop()
            place, low, n = self.near(values, first, end)
            if n.sum() > HITS and c1 - c0 > 1:
                mid = (c0 + c1) // 2
                yield from self.peaks(ids, b, begin, nb, c0, mid)
                yield from self.peaks(ids, b, begin, nb, mid, c1)
                return
            if n.sum() > HITS and end - first > 1:
                mid = (first + end) // 2
                todo += [(first, mid), (mid, end)]
                continue
            wide = int(self.na[first:end].max() + nb[c0:c1].max()) + 1
            keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for k, stop in spans(n, HITS):  # more than one only for a single start and recording
                many = n[k:stop]
                at, i = np.repeat(low[k:stop], many) + ragged(many), np.repeat(place[k:stop], many)
                key = (self.start[at] * (c1 - c0) + of[i] - c0) * wide + pos[i] - self.at[at] + int(self.na[first:end].max())
                got, often = np.unique(key, return_counts=True)
                keys, back = np.unique(np.concatenate([keys, got]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([counts, often]), len(keys)).astype(np.int64)
            pair, offset = keys // wide, keys % wide - int(self.na[first:end].max())
            start, other = pair // (c1 - c0), pair % (c1 - c0) + c0
            keep = (4 * counts > run_of(np.minimum(self.na[start], nb[other]))) & (self.queries[start] != ids[other])
            rows.append(self.held(b, begin, nb, start[keep], other[keep], offset[keep]))
        start, other, offset, matches, error = (np.concatenate(x) for x in zip(*rows, strict=True))
        query, other = self.queries[start], ids[other]
        order = np.lexsort((offset, np.abs(offset), error, -matches, other, query))
        query, other = query[order], other[order]
        new = np.ones(len(order), bool)
        new[1:] = (query[1:] != query[:-1]) | (other[1:] != other[:-1])
        yield query[new], other[new], offset[order][new], matches[order][new], error[order][new]

    def held(self, b, begin, nb, start, other, offset):
        """The candidates whose least bit error of a run is below LIMIT, with equal integers and that error."""
        first = np.maximum(0, -offset)
        long = np.minimum(self.na[start], nb[other] - offset) - first
        run = run_of(np.minimum(self.na[start], nb[other]))
        keep = long >= run
        start, other, offset, first, long, run = (x[keep] for x in (start, other, offset, first, long, run))
        matches, error = np.zeros(len(start), np.int64), np.zeros(len(start))
        for k, stop in spans(long, 8 * HITS):
            n, r, within = long[k:stop], run[k:stop], ragged(long[k:stop])
            left = self.a[np.repeat(self.begin[start[k:stop]] + first[k:stop], n) + within]
            right = b[np.repeat(begin[other[k:stop]] + first[k:stop] + offset[k:stop], n) + within]
            bits = np.bitwise_count(left ^ right).astype(np.int64)
            total, begins, runs = np.concatenate([[0], bits.cumsum()]), n.cumsum() - n, n - r + 1
            at = np.repeat(begins, runs) + ragged(runs)
            matches[k:stop] = np.add.reduceat((bits == 0).astype(np.int64), begins)
            error[k:stop] = np.minimum.reduceat(total[at + np.repeat(r, runs)] - total[at], runs.cumsum() - runs) / (32 * r)
        keep = error < LIMIT
        return start[keep], other[keep], offset[keep], matches[keep], error[keep]

    def found(self, ids, prints: list):
        """The rows of peaks for all recordings, some thousand integers of them at a time."""
        b, begin, nb = flat(prints)
        cuts = [0, *(np.flatnonzero(np.diff(begin // (1 << 16))) + 1), len(nb)] if len(nb) else [0]
        for c0, c1 in zip(cuts[:-1], cuts[1:], strict=True):
            yield from self.peaks(ids, b, begin, nb, int(c0), int(c1))


def best_of(rows: list) -> list:
    """(query, n_aligned, other, offset, matches, bit error): the number of each query's rows and the best of them."""
    query, n, other, offset, matches, error = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.lexsort((other, -matches, error, query))
    query = query[order]
    begins = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, np.int64)
    counts = np.add.reduceat(n[order], begins) if len(begins) else n
    return [query[begins], counts, *(x[order][begins] for x in (other, offset, matches, error))]


def searched(prints: DataFrame, pairs: bool) -> DataFrame:
    """Queries in blocks against all recordings in parts, each block with each part in a task of its own.

    Hits are counted within the task, so what is shuffled are blocks and parts and not the
    hits of integers that many recordings share. Blocks and parts hold about POINTS and
    INTEGERS integers at any size of the corpus.
    """
    points = F.aggregate(F.transform("shifted", lambda x: F.size(x)), F.lit(0).cast("long"), lambda x, y: x + y)
    total = prints.agg(F.sum(points), F.sum(F.size("fingerprint"))).first()
    blocks, parts = max(1, -(-(total[0] or 0) // POINTS)), max(PARTS, -(-(total[1] or 0) // INTEGERS))
    dealt = F.pmod(F.xxhash64("class_id"), F.lit(blocks)), F.pmod(F.xxhash64(F.lit(1), F.col("class_id")), F.lit(parts))
    each_block, each_part = (F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) for n in (blocks, parts))
    asked = prints.where("shifted is not null").select(dealt[0].alias("block"), F.col("class_id").alias("query"), F.explode("shifted").alias("a")).select("block", each_part.alias("part"), "query", "a")
    rest = prints.select(each_block.alias("block"), dealt[1].alias("part"), F.col("class_id").alias("other"), F.col("fingerprint").alias("b"))

    def hold(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, seen = [], 0
        if left.num_rows and right.num_rows:
            search = Search(left["query"].to_numpy(), [x.values for x in left["a"]])
            for query, other, offset, matches, error in search.found(right["other"].to_numpy(), [x.values for x in right["b"]]):
                rows.append([query, np.ones(len(query), np.int64), other, offset, matches, error])
                seen += len(query)
                if not pairs and seen > HITS:
                    rows, seen = [best_of(rows)], 0
        if rows:
            query, n, other, offset, matches, error = (np.concatenate(x) for x in zip(*rows, strict=True)) if pairs else best_of(rows)
        else:
            query = n = other = offset = matches = np.zeros(0, np.int64)
            error = np.zeros(0)
        return pa.table({"query": query, "n_aligned": n, "other": other, "offset": offset, "matches": matches, "bit_error": error})

    many = min(blocks * parts, 1 << 16)
    left, right = (x.repartition(many, "block", "part").groupBy("block", "part") for x in (asked, rest))
    return left.cogroup(right).applyInArrow(hold, "query long, n_aligned long, other long, offset long, matches long, bit_error double")


def aligned(prints: DataFrame) -> DataFrame:
    """query, other, offset, matches, bit_error of all aligned classes (class_id, fingerprint, shifted: null but for queries)."""
    return searched(prints, True).drop("n_aligned")


def best_aligned(prints: DataFrame) -> DataFrame:
    """query, n_aligned and the best aligned class of each query that has one."""
    best = F.min_by(F.struct("other", "offset", "bit_error"), F.struct("bit_error", -F.col("matches"), "other")).alias("best")
    return searched(prints, False).groupBy("query").agg(F.sum("n_aligned").alias("n_aligned"), best)


def matched(media: DataFrame, id_column: str, column: str, every: int = EVERY) -> DataFrame:
    """One row per recording: class, windows, integers, crc; for queries' classes the number of aligned classes and the best of them."""
    rows = written(fingerprinted(media, id_column, column, every), "fingerprints")
    key = F.when((F.col("n_integers") > 0) & F.col("id").isNotNull(), F.sha2(F.to_json(F.struct("fingerprint")), 256))
    rows = rows.withColumn("key", key)
    classes = rows.where("key is not null").groupBy("key").agg(F.min("id").alias("class_id"), F.max(F.col("id") % every == 0).alias("is_query"), F.first("fingerprint").alias("fingerprint"), F.min_by("shifted", F.when(F.col("shifted").isNotNull(), F.col("id"))).alias("shifted"))
    classes = written(classes, "classes")
    found = best_aligned(classes).withColumnRenamed("query", "class_id")
    whole = classes.select("key", "class_id", "is_query").join(found, "class_id", "left")
    out = rows.join(whole, "key", "left")
    return out.select("id", F.coalesce("class_id", "id").alias("class_id"), "n_windows", "n_integers", F.col("crc").alias("fingerprint_crc"), F.coalesce("is_query", F.lit(False)).alias("is_query"), F.coalesce("n_aligned", F.lit(0)).cast("long").alias("n_aligned"), F.col("best.other").alias("best_class"), F.col("best.offset").alias("best_offset"), F.col("best.bit_error").alias("bit_error"))


def op1_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of pages.html taken as 8-bit recordings."""
    return matched(table(spark, sf_dir, "pages"), "page_id", "html").withColumnRenamed("id", "page_id")


QUERIES["op1_chroma_fingerprints"] = op1_chroma_fingerprints
