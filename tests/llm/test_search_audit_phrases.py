"""Nearest neighbours, filter audit and phrase collocations against brute force."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import audit, hnsw, neighbours, phrases

VECTORS = "vec_id long, embedding array<float>, label int, v int, ids string, score double"


def searched(rows, **sizes):
    own = neighbours.usable(rows)
    return neighbours.searched(neighbours.indexed(own, **sizes), own.where("vec_id % 20 = 0"))


def brute(rows, k=20):
    own = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            own[i] = min(own[i], list(v)) if i in own else list(v)
    out = {}
    for q in sorted(i for i in own if i % 20 == 0):
        a = np.array(own[q])
        got = sorted((-float((np.array(v) * a).sum()), i) for i, v in own.items() if i != q and len(v) == len(a))[:k]
        for rank, (score, i) in enumerate(got, 1):
            out[q, rank] = (i, -score)
    return out


def test_neighbours_small(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(np.float32(x)) for x in v] for v in rng.normal(size=(30, 6))]
    rows = [(k, vectors[k % 30]) for k in range(300)]  # ten copies of each vector: ties
    rows += [(k, vectors[0]) for k in range(300, 500)]  # a hot vector
    rows += [(1000, None), (1020, [0.0] * 6), (1040, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1060, [float("nan")] * 6), (1080, [float("inf")] + [1.0] * 5), (None, vectors[1]), (1100, [1.0, 2.0]), (1101, [0.5, -1.0]), (1120, []), (20, vectors[20])]
    table = spark.createDataFrame([(i, v, 0, 1, "x", 0.5) for i, v in rows], VECTORS)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in searched(table).collect()}
    assert got == brute(rows)
    assert {k: v[0] for k, v in got.items() if k[0] == 1100} == {(1100, 1): 1101}
    split = {(r.query_id, r.rank): (r.vec_id, r.score) for r in searched(table, shard=7).collect()}
    assert split == got
    assert searched(table.limit(0)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 48)) * rng.uniform(0.5, 2, size=(3000, 1))  # lengths differ
    x[1000:2000] = x[7] + 0.05 * rng.normal(size=(1000, 48))  # a third of all rows close together
    graph = hnsw.Graph.built(x)
    queries = np.arange(0, 3000, 20)
    found = graph.search(x[queries], neighbours.WIDTH)
    true = np.argsort(-(x[queries] @ x.T), 1)[:, :20]
    assert np.mean([len(np.intersect1d(t, graph.order[f[f >= 0]])) / 20 for t, f in zip(true, found, strict=True)]) >= 0.9
    assert all(len(own) == len(links) and links.max() < len(own) for own, links in zip(graph.nodes, graph.links, strict=True))


DOCS = "doc_id long, text string, source string, lang string, words__ string, mask int, n long"


def audit_by_hand(docs, labels):
    first, seen = {}, {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, q, x in (own for own in labels if own[0] is not None):
        own = seen.setdefault(i, [0, 0])
        own[0], own[1] = max(own[0], int(q == 1)), max(own[1], int(x == 1))
    parts = {}
    for i, t, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and first[t] < i}
        parts.setdefault(s or "", []).append(({c for c, f in fails.items() if f}, *seen.get(i, (0, 0))))
    out = {}
    for part, rows in parts.items():
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            for k, c in enumerate(order):
                before = set(order[:k])
                here = [r for r in rows if c in r[0] and not before & r[0]]
                out[part, "".join(order), k + 1] = [sum(not (before | {c}) & r[0] for r in rows), len(here), sum(c in r[0] and bool(before & r[0]) for r in rows), sum(r[0] == {c} for r in rows), sum(r[1] for r in here), sum(r[2] for r in here)]
                total[c] += len(here)
        for (p, order, k), v in out.items():
            if p == part:
                v.append(total[order[k - 1]])
    return out


def test_audit(spark):
    rng = random.Random(2)
    long = " ".join(f"word{k}" for k in range(250))
    texts = [None, "", "a b", long, long.upper(), "x " * 300, long + " 100%", "#" * 30_000, "é ü " * 400, " ".join("abc"), long + "\n\tUP " * 40]
    docs = [(k, rng.choice(texts), rng.choice([None, "", "web", "books"])) for k in range(120)] + [(None, long, "web"), (None, None, None), (3, long, "web"), (3, long, "web")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 120, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    table = spark.createDataFrame([(i, t, s, None, "x", 7, 7) for i, t, s in docs], DOCS)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in audit.filter_audit(table, known).collect()}
    assert got == audit_by_hand(docs, labels)
    assert audit.filter_audit(table.limit(0), known).count() == 0
    assert audit.filter_audit(table, known.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def phrases_by_hand(docs, support, top):
    f, total = Counter(), Counter()
    for text, lang in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(words)
            for k in range(1, 5):
                f.update(("und" if lang is None else lang, tuple(words[a : a + k])) for a in range(len(words) - k + 1))
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= support:
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found[lang, p] = (score, a, f[lang, p[:k]], f[lang, p[k:]])
    covered = {(lang, q[a : a + k]) for (lang, q), v in found.items() for k in range(2, len(q)) for a in range(len(q) - k + 1) if 100 * v[1] >= 80 * f[lang, q[a : a + k]]}
    out = []
    for lang in total:
        own = sorted((-v[0], -v[1], " ".join(p).encode(), v[2], v[3]) for (x, p), v in found.items() if x == lang and (x, p) not in covered)[:top]
        out += [(lang, rank, p.decode(), -a, left, right, total[lang], -s) for rank, (s, a, p, left, right) in enumerate(own, 1)]
    return sorted(out)


@pytest.mark.parametrize("shards, support, top, parts", [(4, 6, 2000, 5), (1, 3, 7, 1), (3, 2, 2000, 7)])
def test_phrases(spark, shards, support, top, parts):
    rng = random.Random(shards)
    words = ["New", "york", "CITY", "the", "é", "É", "of", " x", "日本", "a b", "state"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!", "\x0b"]) for _ in range(n))
    docs = [(text(rng.randrange(40)), rng.choice(["en", "fr", None, ""])) for _ in range(200)] + [(None, "en"), ("", "xx"), (" . ", None), ("the the the the the the", "en")] + [("same words here again", "en")] * 100 + [("loud " * 30_000, "fr")]
    table = spark.createDataFrame([(t, g, 1, 2, 3) for t, g in docs], "text string, lang string, n long, shard int, h long").repartition(parts)
    got = sorted(tuple(r) for r in phrases.collocations(table, support, top, shards).collect())
    assert got == phrases_by_hand(docs, support, top)
    assert phrases.collocations(table.limit(0)).count() == 0


def test_phrases_pass_a_full_bitmap(spark):
    """A bitmap without room lets more pass, and no result changes."""
    docs = [("one two three four five " * 5, "en")] * 10
    table = spark.createDataFrame(docs, "text string, lang string")
    full = np.full(1 << (phrases.BITS - 3), 255, np.uint8)
    rows = phrases.counted(table, full, 30)
    assert {(r.phrase, r.f) for r in rows.where("words = 4").collect()} == {("one two three four", 50), ("two three four five", 50), ("three four five one", 40), ("four five one two", 40), ("five one two three", 40)}


def test_phrases_count_only_what_the_first_need(spark, monkeypatch):
    """What the last pass counts does not grow with all frequent phrases."""
    docs = [(f"left{k} right{k}. left{k} common", "en") for k in range(120) for _ in range(3 + k)]
    table = spark.createDataFrame(docs, "text string, lang string").repartition(6)
    places, counted = [], phrases.counted

    def watched(own, bits, support):
        places.append(int(np.unpackbits(bits).sum()))
        return counted(own, bits, support)

    monkeypatch.setattr(phrases, "counted", watched)
    got = sorted(tuple(r) for r in phrases.collocations(table, 3, 5, 2).collect())
    assert got == phrases_by_hand(docs, 3, 5)
    assert len(got) == 5 and 0 < places[-1] <= 2 * 5 * 3  # two places for a phrase and its two parts; 962 with all frequent ones


def test_phrases_dealt_otherwise(spark):
    """Phrases whose task does not hold them any more are still linked with their parts."""
    table = spark.createDataFrame([("one two three four", "en")] * 40 + [("two three", "en")] * 9, "text string, lang string").repartition(3)
    short = phrases.mined(table, 30, 2)
    frequent = short.union(phrases.mined(table, 30, 2, phrases.bitmap(short.select("h"))))
    best, needed = ({r.h for r in rows.collect()} for rows in phrases.chosen(table, frequent, 10))
    moved = tuple({r.h for r in rows.collect()} for rows in phrases.chosen(table, frequent.selectExpr("h", "n", "home + 50 AS home", "word"), 10))
    assert (best, needed) == moved and len(best) == 1
