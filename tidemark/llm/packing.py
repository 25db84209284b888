"""Operator 10: best-fit packing of tokenised documents by linear grouping.

Token counts are at most the sequence length, so a histogram of lengths has at
most that many rows however many documents there are. The plan is made from it
alone: full pieces stand alone; large lengths are rounded up within groups of
equal cardinality; a configuration linear programme over those few sizes (column
generation) says how many sequences hold which sizes; actual lengths take the
places of rounded ones; what is left, and all small pieces, fill the gaps best
fit first. The plan is a bounded list of runs of ranks within a length, and
Spark numbers the pieces within each length and looks their places up.

Nulls count as empty texts. Repeated rows are packed as often as they occur.
An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import QUERIES, STORES, slices, table, written

SEQUENCE = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Characters of words kept per Python worker (each word counts 16 more); beyond that the store starts anew. It bounds memory and changes no result.
KEPT = 32_000_000
_encoders: dict[str, WordEncoder] = STORES.setdefault("words", {})


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, the same as the library gives for whole texts.

    The tokenizer drops white space and nothing it matches crosses a space or a newline, so
    each word is encoded once and its ids are reused. It composes letters with their marks
    first and lower-cases then; where a text and its lower-case form are both composed, the
    order is the same and fewer words differ. Special tokens are matched as they are written.
    """

    def __init__(self, path: str, kept: int = KEPT):
        from tokenizers import Tokenizer

        self.tokenizer, self.kept = Tokenizer.from_file(path), kept
        self.known: dict[str, bytes] = {"": b""}
        self.size = 0

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = []
        for text in texts:
            text = text or ""
            if "<|" not in text:
                plain = text.isascii()
                low = text.lower() if plain else text.encode(errors="replace").lower().decode()
                if plain or is_normalized("NFC", text) and is_normalized("NFC", low):
                    text = low
            split.append(text.replace("\n", " ").split(" "))
        known, words = self.known, set().union(*split) if split else set()
        if self.size > self.kept:
            known.clear()
            self.size = 0
        new = list(words.difference(known))
        self.size += sum(map(len, new)) + 16 * len(new)
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            for word, got in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[word] = np.array(got.ids, "<u4").tobytes()
        return [b"".join([known[w] for w in own]) for own in split]


def encoder_of(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def encode_texts(texts: list[str | None], path: str) -> list[bytes]:
    return encoder_of(path).encode(texts)


def tokenised_pieces(docs: DataFrame, path: str, end_id: int = 0, size: int = SEQUENCE, kept: int = KEPT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: ids of the document and end_id, cut every size tokens. With kept below KEPT a task's store is that much smaller and goes with the task, which takes more time and less memory."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = encoder_of(path) if kept >= KEPT else WordEncoder(path, kept)
        for batch in batches:
            for part in slices(batch, 1, 1_000_000):
                out = ([], [], [], [], [])
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    ids += end
                    for k, s in enumerate(range(0, len(ids), 4 * size)):
                        own = ids[s : s + 4 * size]
                        for column, value in zip(out, (doc, k, s // 4, len(own) // 4, zlib.crc32(own)), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, float]]:
    """Patterns over the sizes and how often each is used, by column generation on the fractional configuration programme."""
    m, s, b = len(sizes), np.array(sizes), np.array(demand, float)
    basis = np.diag((capacity // s).astype(float))
    x = b / np.diag(basis)
    for _ in range(rounds):
        y = np.linalg.solve(basis.T, np.ones(m))
        best = [np.zeros(capacity + 1)]
        for size, value in zip(sizes, y, strict=True):
            row = best[-1]
            if value > 0:
                row = row.copy()
                for _ in range(capacity // size):
                    more = row[:-size] + value
                    if not (more > row[size:] + 1e-12).any():
                        break
                    row[size:] = np.maximum(row[size:], more)
            best.append(row)
        if best[-1][capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(m), capacity
        for k in range(m - 1, -1, -1):
            while c >= sizes[k] and best[k + 1][c] > best[k][c] + 1e-12:
                if best[k + 1][c] > best[k + 1][c - sizes[k]] + y[k] + 1e-9:
                    c -= 1
                    continue
                column[k] += 1
                c -= sizes[k]
        if y @ column <= 1 + 1e-9:
            break
        d = np.linalg.solve(basis, column)
        ratios = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        leave = int(ratios.argmin())
        if not np.isfinite(ratios[leave]):
            break
        x = x - ratios[leave] * d
        x[leave] = ratios[leave]
        basis[:, leave] = column
    return [(basis[:, k].astype(int), float(x[k])) for k in range(m) if x[k] > 1e-9]


def sequences(runs: np.ndarray) -> int:
    return int((runs[:, 3] - (runs[:, 1] - runs[:, 2]) // runs[:, 4]).max()) if len(runs) else 0


def plan_runs(counts: dict[int, int], capacity: int = SEQUENCE) -> np.ndarray:
    """The plan of fewest sequences over a few numbers of groups and limits of small lengths."""
    return min((grouped_runs(counts, capacity, g, max(1, capacity // k)) for g in (24, 48, 96) for k in (16, 5, 3)), key=sequences)


def grouped_runs(counts: dict[int, int], capacity: int, groups: int, small: int) -> np.ndarray:
    """Runs (length, first rank, end rank, first sequence, pieces of the run per sequence, offset).

    The number of runs depends on the capacity and the number of groups, not on the counts.
    """
    runs: list[tuple[int, int, int, int, int, int]] = []
    left: dict[int, list[list[int]]] = defaultdict(list)  # by length: [first rank, number]
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by free room: (first sequence, number)
    seq = 0
    if n := counts.get(capacity, 0):
        runs.append((capacity, 0, n, 0, 1, 0))
        seq = n
    large = [(length, counts[length]) for length in sorted(counts, reverse=True) if small < length < capacity and counts[length]]
    total = sum(n for _, n in large)
    # Groups of equal cardinality, in falling order of length; each has its largest length as size.
    share, grouped, room = -(-total // groups) if total else 0, [], 0
    for length, n in large:
        while n:
            if not room:
                grouped.append([length, 0])
                room = share
            take = min(room, n)
            grouped[-1][1] += take
            n, room = n - take, room - take
    sizes: dict[int, int] = defaultdict(int)
    for size, n in grouped:
        sizes[size] += n
    names, stock, lengths = list(sizes), {length: [0, n] for length, n in large}, sorted(length for length, _ in large)
    patterns = configurations(names, [sizes[s] for s in names], capacity) if names else []
    for pattern, often in sorted(patterns, key=lambda p: -p[1]):
        slots = [s for s, k in zip(names, pattern, strict=True) for _ in range(k)]
        many = int(often + 1e-6)
        open_ = [(seq, many, 0, 0)] if many and slots else []  # first sequence, number, next slot, used
        seq += many if open_ else 0
        while open_:  # actual pieces take the places, the largest that fit; from the last place on they take up what rounding left
            first, many, k, used = open_.pop()
            limit = capacity - used if k >= len(slots) - 1 else min(slots[k], capacity - used)
            at = bisect_right(lengths, limit)
            if not at:
                gaps[capacity - used].append((first, many))
                continue
            length = lengths[at - 1]
            rank, n = stock[length]
            take = min(many, n)
            runs.append((length, rank, rank + take, first, 1, used))
            stock[length] = [rank + take, n - take]
            if take == n:
                lengths.pop(at - 1)
            if take < many:
                open_.append((first + take, many - take, k, used))
            open_.append((first, take, k + 1, used + length))
    for length, (rank, n) in stock.items():
        if n:
            left[length].append([rank, n])
    for length, n in counts.items():
        if length <= small and length < capacity and n:
            left[length].append([0, n])
    for length in sorted(left, reverse=True):
        for rank, n in left[length]:
            while n:
                room = min((r for r, g in gaps.items() if g and r >= length), default=None)
                if room is None:
                    first, many, room = seq, -(-n // (capacity // length)), capacity
                    seq += many
                else:
                    first, many = gaps[room].pop()
                each = room // length
                whole = min(many, n // each)
                if whole:
                    runs.append((length, rank, rank + whole * each, first, each, capacity - room))
                    gaps[room - each * length].append((first, whole))
                    rank, n = rank + whole * each, n - whole * each
                if whole < many and n:  # fewer than fill one more
                    runs.append((length, rank, rank + n, first + whole, n, capacity - room))
                    gaps[room - n * length].append((first + whole, 1))
                    rank, n, whole = rank + n, 0, whole + 1
                if whole < many:
                    gaps[room].append((first + whole, many - whole))
    return np.array(sorted(runs), np.int64).reshape(-1, 6)


def packed(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces with a column length of 1 to size."""
    spark = pieces.sparkSession
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # at most size rows
    runs = spark.sparkContext.broadcast(plan_runs(counts, size))  # bounded by size and groups
    buckets = max(64, min(1 << 16, sum(counts.values()) // 100_000))
    key = pieces.withColumn("bucket_", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = key.groupBy("length", "bucket_").agg(F.count("*").alias("n_")).select("length", "bucket_", (F.sum("n_").over(Window.partitionBy("length").orderBy("bucket_")) - F.col("n_")).alias("before_"))
    number = F.row_number().over(Window.partitionBy("length", "bucket_").orderBy("doc_id", "piece"))
    ranked = key.withColumn("number_", number - 1).join(before, ["length", "bucket_"]).withColumn("rank_", F.col("before_") + F.col("number_"))
    names = pieces.columns

    def place(batches):
        plan = runs.value
        order = plan[:, 0] * (1 << 44) + plan[:, 1]
        for batch in batches:
            length, rank = batch.column(batch.schema.get_field_index("length")).to_numpy(), batch.column(batch.schema.get_field_index("rank_")).to_numpy()
            run = plan[np.searchsorted(order, length * (1 << 44) + rank, "right") - 1]
            along = rank - run[:, 1]
            sequence, offset = run[:, 3] + along // run[:, 4], run[:, 5] + along % run[:, 4] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(names))), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*names, "rank_").mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, size: int = SEQUENCE, kept: int = KEPT) -> DataFrame:
    """Each document's pieces with the sequence and the place in it where they stand."""
    return packed(written(tokenised_pieces(docs, path, end_id, size, kept), "pieces"), size)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES["op10_best_fit_packing"] = op10_best_fit_packing
