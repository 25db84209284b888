"""Operator 7: SentencePiece encoding and decoding with a merge-type prefix table.

For every prefix of a chunk the table holds the one token that ends the prefix's
encoding. It is found among the vocabulary entries that end there (an Aho-Corasick
automaton lists them, longest first): the first that is compatible with the last
token of the prefix before it, that is, the pair of them encodes to just that pair.
Walking back from the whole chunk's last token gives its ids.

Texts are cut where no vocabulary entry reaches across: before each run of word
separators and around newlines. Both facts are tested when the model is loaded.
Runs of separators hold equally scored entries and are merged from the left.

Null texts count as empty and give no ids. Any row gives one row; repeated rows
stay; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import QUERIES, STORES, table

SPACE = "▁"
#: Chunks kept per Python worker; beyond that the store starts anew. It bounds memory and changes no result.
CHUNKS_KEPT = 500_000
_codecs: dict[str, PieceCodec] = STORES.setdefault("pieces", {})


class PieceCodec:
    """The ids of a merge-type model, by prefix tables."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not model.trainer_spec.byte_fallback:
            raise ValueError("a merge-type model with byte fallback, a leading separator and no normalisation is needed")
        self.piece = [p.piece for p in model.pieces]
        self.score = [p.score for p in model.pieces]
        self.id = {p.piece: k for k, p in enumerate(model.pieces) if p.type == 1}
        self.byte = {int(p.piece[3:5], 16): k for k, p in enumerate(model.pieces) if p.type == 6}
        self.byte_of = {k: b for b, k in self.byte.items()}
        self.control = {k for k, p in enumerate(model.pieces) if p.type == 3}
        self.unknown = next((k for k, p in enumerate(model.pieces) if p.type == 2), -1)
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.id):
            raise ValueError("an entry reaches across a separator or a newline")
        self.automaton = ahocorasick.Automaton()
        for p, k in self.id.items():
            self.automaton.add_word(p, (len(p), k))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.spaces: dict[int, list[int]] = {}
        self.known: dict[str, tuple[str, str]] = {}

    def merged(self, text: str) -> list[int | str]:
        """Plain merging, best score first, then leftmost; characters without an entry stay as they are."""
        symbols, after, before = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(a: int, b: int) -> None:
            if 0 <= a and b < len(symbols) and (k := self.id.get(symbols[a] + symbols[b])) is not None:
                heapq.heappush(heap, (-self.score[k], a, symbols[a] + symbols[b]))

        for a in range(len(symbols) - 1):
            offer(a, a + 1)
        while heap:
            _, a, got = heapq.heappop(heap)
            b = after[a]
            if not symbols[a] or b >= len(symbols) or symbols[a] + symbols[b] != got:
                continue
            symbols[a], symbols[b], after[a] = got, "", after[b]
            if after[b] < len(symbols):
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [self.id.get(s, s) for s in symbols if s]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the text of both encodes to just this pair."""
        key = a << 20 | b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            got = self.pairs[key] = self.merged(self.piece[a] + self.piece[b]) == [a, b]
        return got

    def stands(self, a: int) -> bool:
        """Whether the entry's own text encodes to it."""
        if a not in self.alone:
            self.alone[a] = self.merged(self.piece[a]) == [a]
        return self.alone[a]

    def word(self, chunk: str) -> list[int]:
        """Ids of a chunk with at most one separator, in front."""
        ends: list[list[tuple[int, int]]] = [[] for _ in range(len(chunk) + 1)]
        for end, found in self.automaton.iter(chunk):
            ends[end + 1].append(found)
        last, back, pairs = [-1] * (len(chunk) + 1), [1] * (len(chunk) + 1), self.pairs
        for i in range(1, len(chunk) + 1):
            found = ends[i]
            if len(found) > 1 and found[0][0] < found[-1][0]:
                found.reverse()
            for n, k in found:
                p = last[i - n]
                if p < 0:
                    ok = self.stands(k)  # the chunk's start, or after a character without an entry
                else:
                    ok = pairs.get(p << 20 | k)
                    if ok is None:
                        ok = self.compatible(p, k)
                if ok:
                    last[i], back[i] = k, n
                    break
        ids: list[int] = []
        i = len(chunk)
        while i:
            if last[i] >= 0:
                ids.append(last[i])
            else:
                ids += [self.byte[b] for b in reversed(chunk[i - 1].encode())]
            i -= back[i]
        return ids[::-1]

    def run(self, n: int) -> list[int]:
        """Ids of n separators; for long runs the largest entries from the left."""
        if n not in self.spaces:
            if len(self.spaces) > 10_000:
                self.spaces.clear()
            self.spaces[n] = self.merged(SPACE * n)
        return self.spaces[n]

    def chunk(self, chunk: str) -> list[int]:
        """Ids of separators and what follows them. Separators merge last among themselves, after the word has taken one or none."""
        rest = chunk.lstrip(SPACE)
        n = len(chunk) - len(rest)
        if n < 2:
            return self.word(chunk)
        if not rest:
            return self.run(n)
        ids = self.word(SPACE + rest)
        return self.run(n) + ids[1:] if self.piece[ids[0]] == SPACE else self.run(n - 1) + ids

    def text_of(self, ids: list[int]) -> str:
        """What ids stand for, without the first separator's removal."""
        out = bytearray()
        for k in ids:
            if k in self.byte_of:
                out.append(self.byte_of[k])
            elif k not in self.control:
                out += (" ⁇ " if k == self.unknown else self.piece[k].replace(SPACE, " ")).encode()
        return out.decode(errors="replace")

    def decode(self, ids: list[int]) -> str:
        text = self.text_of(ids)
        return text[1:] if ids and self.piece[ids[0]].startswith(SPACE) else text

    def look(self, chunk: str) -> tuple[str, str]:
        """The chunk's ids in decimal, each after a comma, and their text."""
        got = self.known.get(chunk)
        if got is None:
            ids = self.chunk(chunk)
            got = self.known[chunk] = "".join([f",{k}" for k in ids]), self.text_of(ids)
        return got

    def both(self, text: str) -> tuple[str, str]:
        """Ids of the whole text in decimal, joined by commas, and what they decode to."""
        if not text:
            return "", ""
        if len(self.known) > CHUNKS_KEPT:
            self.known.clear()
        known, look, ids, out = self.known, self.look, [], []
        newline = None
        for line in (SPACE + text.replace(" ", SPACE)).split("\n"):
            if newline is None:
                newline = look("\n")
            else:
                ids.append(newline[0])
                out.append(newline[1])
            if not line:
                continue
            words = line.split(SPACE)
            if "" not in words[1:]:
                chunks = [words[0]] if words[0] else []
                chunks += [SPACE + w for w in words[1:]]
            else:
                chunks, start = [], 0
                for i in range(1, len(line)):
                    if line[i] == SPACE and line[i - 1] != SPACE:
                        chunks.append(line[start:i])
                        start = i
                chunks.append(line[start:])
            try:
                got = [known[c] for c in chunks]
            except KeyError:
                got = [look(c) for c in chunks]
            ids += [g[0] for g in got]
            out += [g[1] for g in got]
        decoded = "".join(out)
        return "".join(ids)[1:], decoded[1:]  # the first separator stands for none in the text

    def encode(self, text: str) -> list[int]:
        ids = self.both(text)[0]
        return [int(k) for k in ids.split(",")] if ids else []


def codec(path: str) -> PieceCodec:
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by commas), decoded: one row per row."""

    def encode(batches):
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                got = [own.both(t or "") for t in part.column(1).to_pylist()]
                n = [ids.count(",") + 1 if ids else 0 for ids, _ in got]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, "doc_id long, n_tokens long, ids string, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """The same with SHA-256 digests in place of ids and text; these are taken in the worker, so that long columns don't travel."""

    def encode(batches):
        own = codec(path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                n, a, b = [], [], []
                for t in part.column(1).to_pylist():
                    ids, text = own.both(t or "")
                    n.append(ids.count(",") + 1 if ids else 0)
                    a.append(sha(ids))
                    b.append(sha(text))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_sentencepiece_prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES["op7_sentencepiece_prefix_table"] = op7_sentencepiece_prefix_table
