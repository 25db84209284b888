"""Operator 6: a quality classifier that is a sparse ensemble of rules.

Statistics of each whole text (shares of character classes, word and line lengths,
repetition) feed small boosted trees fitted on a bounded sample of labelled rows
(SAMPLE rows, by hash of the id). Every path from a root to a node is a rule, a
conjunction of comparisons; a lasso logistic regression weighs the rules and drops
most of them; what remains is compiled into one Spark column expression.

Null texts count as empty and get a score like any other. Several labels of one id
all count. Without training rows every score is 0.5. Each row gives one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import QUERIES, appended, crc32_mod, hash_sample, table

SAMPLE = 8000
THRESHOLD = 0.3
STATS = ("size", "words", "lines", "upper", "digit", "punct", "bar", "bang", "space", "high", "word_len", "long_word", "short_word", "caps_word", "line_len", "distinct_words", "distinct_lines", "top_run", "stops", "symbol", "two_upper")
_kind = np.zeros((8, 256), bool)
for _b in range(128):
    _c = chr(_b)
    _kind[0, _b], _kind[1, _b], _kind[2, _b], _kind[3, _b] = _c.isupper(), _c.isdigit(), _c in ".,;:!?'\"()-", _c.isspace()
    _kind[4, _b], _kind[5, _b], _kind[6, _b] = _c == "|", _c == "!", _c.isprintable() and not _c.isalnum() and not _c.isspace() and _c not in ".,;:!?'\"()-"
_kind[7, 128:] = True


def statistics(texts: list[str | None]) -> np.ndarray:
    """A row of STATS for each text."""
    raw = [(t or "").encode(errors="replace") for t in texts]
    joined = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    sizes = np.array([len(r) for r in raw])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    per = lambda flags: np.add.reduceat(flags.astype(np.int32), starts)
    n = np.maximum(sizes, 1)
    kinds = [_kind[k][joined] for k in range(8)]
    space, upper = kinds[3], kinds[0]
    first = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    doc = np.searchsorted(starts, first, "right") - 1
    length = end - first
    words = np.bincount(doc, minlength=len(raw))
    w = np.maximum(words, 1)
    caps = np.add.reduceat(upper.astype(np.int32), np.minimum(np.stack([first, end], 1).ravel(), len(joined) - 1))[::2] if len(first) else np.zeros(0)
    share = lambda flags: np.bincount(doc, flags, len(raw)) / w
    lines = [r.split(b"\n") for r in raw]
    n_lines = np.array([len(x) for x in lines])
    own = [r.lower().split() for r in raw]
    distinct = [len(set(x)) for x in own]
    pairs = np.concatenate([[False], upper[1:] & upper[:-1]])
    newline = joined == 10
    shorter = length <= 3
    columns = [
        np.log1p(sizes), np.log1p(words), np.log1p(n_lines), per(upper) / n, per(kinds[1]) / n, per(kinds[2]) / n, per(kinds[4]) / n, per(kinds[5]) / n,
        per(space) / n, per(kinds[7]) / n, np.bincount(doc, length, len(raw)) / w, share(length > 12), share(shorter), share(caps >= 2), sizes / (per(newline) + 1),
        np.array(distinct) / w, np.array([len(set(x)) for x in lines]) / n_lines, np.log1p(w / np.maximum(distinct, 1)), share(length == 2), per(kinds[6]) / n, per(pairs) / n,
    ]
    return np.stack([c.astype(float) for c in columns], 1)


def with_statistics(docs: DataFrame, prefix: str = "stat_") -> DataFrame:
    """All columns of docs (one of them text) and the statistics as doubles."""
    return appended(docs, "text", ", ".join(f"{prefix}{s} double" for s in STATS), lambda texts: [pa.array(c) for c in statistics(texts).T])


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, at most, limit) and so on


def grown(x: np.ndarray, target: np.ndarray, weight: np.ndarray, columns: np.ndarray, depth: int, least: int, path: Rule, rules: list[Rule], out: np.ndarray, rows: np.ndarray) -> None:
    """A regression tree on the rows; adds the paths of its nodes to rules and its Newton steps to out."""
    if path:
        rules.append(path)
    best = None
    g, h = target[rows], weight[rows]
    if depth and len(rows) >= 2 * least:
        base = g.sum() ** 2 / (h.sum() + 1e-9)
        for c in columns:
            v = x[rows, c]
            for limit in np.unique(np.quantile(v, np.linspace(0.04, 0.96, 24))):
                low = v <= limit
                k = int(low.sum())
                if k < least or len(rows) - k < least:
                    continue
                gl, hl = g[low].sum(), h[low].sum()
                gain = gl**2 / (hl + 1e-9) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1e-9) - base
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, int(c), float(limit), low)
    if best is None or best[0] < 1e-6:
        out[rows] = g.sum() / (h.sum() + 1.0)
        return
    _, c, limit, low = best
    grown(x, target, weight, columns, depth - 1, least, (*path, (c, True, limit)), rules, out, rows[low])
    grown(x, target, weight, columns, depth - 1, least, (*path, (c, False, limit)), rules, out, rows[~low])


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, seed: int = 1) -> list[Rule]:
    """The distinct paths of boosted trees, each on a part of rows and statistics."""
    rng, rules = np.random.default_rng(seed), []
    score = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        rows = np.sort(rng.permutation(len(y))[: max(min(len(y), 400), len(y) // 2)])
        columns = np.sort(rng.permutation(x.shape[1])[: max(3, x.shape[1] // 2)])
        part = np.zeros(len(rows))
        own: list[Rule] = []
        grown(x[rows], (y - p)[rows], (p * (1 - p))[rows], columns, depth, 12, (), own, part, np.arange(len(rows)))
        rules += own
        leaves = [r for r in own if not any(q[: len(r)] == r and q != r for q in own)]
        for leaf in leaves:
            inside = holds(x[rows], leaf)
            if inside.any():
                score[holds(x, leaf)] += 0.3 * np.clip(part[inside][0], -4, 4)
    return list(dict.fromkeys(rules))


def holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    inside = np.ones(len(x), bool)
    for c, low, limit in rule:
        inside &= (x[:, c] <= limit) == low
    return inside


def lasso_logistic(a: np.ndarray, y: np.ndarray, strength: float = 2e-3, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient."""
    n, m = a.shape
    step = 4 / (np.linalg.norm(a, 2) ** 2 / n + 1)
    b, w, zb, zw, t = 0.0, np.zeros(m), 0.0, np.zeros(m), 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-np.clip(zb + a @ zw, -30, 30))) - y
        nb, nw = zb - step * r.mean(), zw - step * (a.T @ r) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * strength, 0)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        zb, zw = nb + (t - 1) / nt * (nb - b), nw + (t - 1) / nt * (nw - w)
        b, w, t = nb, nw, nt
    return float(b), w


class RuleEnsemble:
    def __init__(self, intercept: float, rules: list[tuple[Rule, float]]):
        self.intercept, self.rules = intercept, rules

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
        if not len(y) or y.min() == y.max():
            return cls(0.0 if not len(y) else 4.0 * (2 * float(y[0]) - 1), [])
        rules = tree_rules(x, y)
        if not rules:  # too few rows for any split
            return cls(float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), [])
        a = np.stack([holds(x, r) for r in rules], 1).astype(float)
        b, w = lasso_logistic(a, y)
        return cls(b, [(r, float(v)) for r, v in zip(rules, w, strict=True) if abs(v) > 1e-6])

    @classmethod
    def train(cls, docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> RuleEnsemble:
        """From docs (doc_id, text) and labels (doc_id, quality) of which a bounded sample is collected as statistics."""
        own = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        own = hash_sample(own, "doc_id", size)
        rows = with_statistics(docs.select("doc_id", "text").join(own, "doc_id")).drop("text").orderBy("doc_id", "quality").toPandas()
        return cls.fit(rows[[f"stat_{s}" for s in STATS]].to_numpy(float), rows["quality"].to_numpy(float))

    def column(self, prefix: str = "stat_") -> Column:
        """The score as a column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            held = F.lit(True)
            for c, low, limit in rule:
                stat = F.col(prefix + STATS[c])
                held = held & ((stat <= F.lit(limit)) if low else (stat > F.lit(limit)))
            total = total + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def train(spark: SparkSession, sf_dir: str, docs: DataFrame) -> RuleEnsemble:
    """From labels of ids whose crc32 is no multiple of 5; the others are held out."""
    labels = table(spark, sf_dir, "labels")
    return RuleEnsemble.train(docs, labels.where(crc32_mod(F.col("doc_id"), 5) != 0))


def accepted(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """Rows with a score of THRESHOLD or more; the columns stay as they are."""
    own = "stat__"
    return with_statistics(docs, own).where(model.column(own) >= THRESHOLD).select(*docs.columns)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(spark, sf_dir, docs)
    scored = with_statistics(docs).select("doc_id", (crc32_mod(F.col("doc_id"), 5) == 0).alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERIES["op6_quality_rules"] = op6_quality_rules
