"""Operator 9: language identification by a mixture over each document's words.

Byte trigrams of lower-cased words, hashed to a table of fixed size, are counted by
language over a bounded sample of labelled documents (SAMPLE rows, by hash of the
id). A word's likelihood in each language is the product over its trigrams. For each
document expectation-maximisation estimates the proportions of the languages in it;
then language sets of growing size are compared by likelihood less a penalty for each
further proportion, and the best set's largest member is the prediction.

Null texts and texts without a letter are `und` with score 0. Null languages train
nothing; without any training row every text is `und`. Each row gives one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import QUERIES, appended, crc32_mod, hash_sample, slices, table

SAMPLE = 6000
BITS = 16
ROUNDS = 8
#: A document is rejected where its main language has less than this share.
LEAST_SHARE = 0.4

_map = np.zeros(256, np.uint32)
for _b in range(256):
    if _b >= 128 or chr(_b).isalpha():
        _map[_b] = ord(chr(_b).lower()) if _b < 128 else _b


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mapped bytes of all texts, a gap before and after each, and where each text starts."""
    raw = [t.encode(errors="replace") for t in texts]
    joined = b" " + b" ".join(raw) + b" "
    starts = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    return _map[np.frombuffer(joined, np.uint8)], starts


def trigrams(m: np.ndarray) -> np.ndarray:
    """A hashed code for each byte with the two before it."""
    code = m * np.uint32(0x9E3779B1)
    code[1:] += m[:-1] * np.uint32(0x85EBCA6B)
    code[2:] += m[:-2] * np.uint32(0xC2B2AE35)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    return (code >> np.uint32(32 - BITS)).astype(np.intp)


def trigram_counts(docs: DataFrame) -> dict[str, np.ndarray]:
    """By language, from a bounded sample with text and lang; at most one number for each language and code."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 0):
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    m, _ = letters([text])
                    inside = (m > 0) | (np.concatenate([[0], m[:-1]]) > 0)
                    got = np.bincount(trigrams(m)[inside], minlength=1 << BITS)
                    total[lang] = total.get(lang, 0) + got
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["lang", "code", "n"])

    rows = docs.select("text", "lang").mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).collect()
    out: dict[str, np.ndarray] = {}
    for lang, code, n in rows:
        out.setdefault(lang, np.zeros(1 << BITS))[code] = n
    return out


class LanguageModel:
    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        self.logs = [np.log((counts[k] + 0.5) / (counts[k].sum() + 0.5 * (1 << BITS))).astype(np.float32) for k in self.langs]

    @classmethod
    def fit(cls, docs: DataFrame, size: int = SAMPLE) -> LanguageModel:
        """From docs with doc_id, text and lang."""
        return cls(trigram_counts(hash_sample(docs.where("text is not null and lang is not null").select("doc_id", "text", "lang"), "doc_id", size)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[str]]:
        """Language, its share in the set chosen, and the set, for each text."""
        n, k = len(texts), len(self.langs)
        pred, score, sets = ["und"] * n, [0.0] * n, [""] * n
        m, starts = letters([t or "" for t in texts])
        inside = m > 0
        first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        if not len(first) or not k:
            return pred, score, sets
        end = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 2  # and the gap that follows
        bounds = np.stack([first, end], 1).ravel()
        bounds = bounds[:-1] if bounds[-1] >= len(m) else bounds
        codes = trigrams(m)
        like = np.empty((len(first), k), np.float32)
        for j, logs in enumerate(self.logs):
            like[:, j] = np.add.reduceat(logs[codes], bounds)[::2]
        del codes
        like -= like.max(1, keepdims=True)
        logs = like.copy()
        np.exp(like, out=like)
        np.maximum(like, 1e-30, out=like)
        doc = np.searchsorted(starts, first, "right") - 1
        at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        which, words = doc[at], np.diff(np.append(at, len(doc)))
        share = np.full((len(which), k), 1 / k, np.float32)
        for _ in range(ROUNDS):
            got = like * np.repeat(share, words, 0)
            got /= got.sum(1, keepdims=True)
            share = np.add.reduceat(got, at, 0) / words[:, None]
        order = np.argsort(-share, 1, kind="stable")
        best = np.full(len(which), -np.inf)
        size = np.ones(len(which), int)
        for s in range(1, k + 1):
            mask = np.zeros_like(share)
            np.put_along_axis(mask, order[:, :s], 1, 1)
            theta = share * mask
            theta = theta / np.maximum(theta.sum(1, keepdims=True), 1e-30)
            if s == 1:
                total = np.add.reduceat((logs * np.repeat(mask, words, 0)).sum(1), at)
            else:
                total = np.add.reduceat(np.log(np.maximum((like * np.repeat(theta, words, 0)).sum(1), 1e-30)), at)
            value = total - 0.5 * (s - 1) * np.log(np.maximum(words, 2))
            better = value > best + 1e-6
            best, size = np.where(better, value, best), np.where(better, s, size)
        for row, d in enumerate(which.tolist()):
            if texts[d] is None or not _has_letter(texts[d]):
                continue
            chosen = order[row, : size[row]]
            theta = share[row, chosen] / max(share[row, chosen].sum(), 1e-30)
            pred[d], score[d], sets[d] = self.langs[chosen[0]], float(min(1.0, max(share[row, chosen[0]], 0.0))), ",".join(f"{self.langs[c]}:{t:.2f}" for c, t in zip(chosen, theta, strict=True))
        return pred, score, sets


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def identified(docs: DataFrame, model: LanguageModel, names: tuple[str, str, str] = ("lang_pred", "score", "languages")) -> DataFrame:
    """All columns of docs (one of them text) and the three named ones."""

    def compute(texts):
        return [pa.array(x, t) for x, t in zip(model.predict(texts), (pa.string(), pa.float64(), pa.string()), strict=True)]

    return appended(docs, "text", f"{names[0]} string, {names[1]} double, {names[2]} string", compute)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(crc32_mod(F.col("doc_id"), 3) != 1)


def accepted(docs: DataFrame) -> DataFrame:
    """Rows whose text has a language with at least LEAST_SHARE of it; the columns stay as they are."""
    model = LanguageModel.fit(training_rows(docs))
    own = ("lang_pred__", "score__", "languages__")
    return identified(docs, model, own).where(f"{own[0]} <> 'und' and {own[1]} >= {LEAST_SHARE}").select(*docs.columns)


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = LanguageModel.fit(training_rows(docs))
    held = (crc32_mod(F.col("doc_id"), 3) == 1).alias("held_out")
    return identified(docs.select("doc_id", held, "text"), model).drop("text")


QUERIES["op9_language_mixture"] = op9_language_mixture
