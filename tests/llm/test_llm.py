"""The corpus operators on small rows: nulls, empty and long texts, repeats, clashing columns, empty tables, brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from tidemark.llm import chroma, exact, graph, jaccard, language, licences, lines, packing, pieces, quality, warc

TEXTS = [None, "", " ", "\n\n", "Une ligne assez longue\ncourte\nUne ligne assez longue", "une LIGNE assez longue \nautre chose ici", "Same text of seven words right here", "same text of Seven words right here", "x" * 30_000, "mot " * 9000, "123 456", "日本語 <|endoftext|> ▁a  b", "Released under the MIT License.\nfoo", "H\u0331ima J\u030c T\u0308 W\u030a Y\u030a E\u0301 I\u0307"]
SCHEMA = "doc_id long, text string, lang string, score double, piece int, kind int, n long, part int"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [(k, t, "fr", 0.0, 1, 2, 3, 4) for k, t in enumerate(TEXTS)] + [(None, "Same text of seven words right here", None, 0.0, 1, 2, 3, 4), (6, TEXTS[6], "fr", 0.0, 1, 2, 3, 4)]
    path = str(tmp_path_factory.mktemp("t") / "docs.parquet")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "none.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def test_packing(docs, empty):
    path = P.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path).collect()
    whole = {k: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for k, t in enumerate(TEXTS)}
    for r in rows:
        if r.doc_id is not None:
            ids = whole[r.doc_id][r.start : r.start + r.length]
            assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32 and r.start == 2048 * r.piece
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(empty, path).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 2049, 3000), np.minimum(rng.lognormal(6, 1, 3000).astype(int) + 1, 2048), rng.integers(700, 1100, 500), rng.integers(1, 9, 9)][seed]
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    seen, room = {k: 0 for k in counts}, {}
    for length, a, b, seq, each, _ in packing.plan_runs(counts).tolist():
        assert a == seen[length]
        seen[length] = b
        for q in range(a, b):
            room[seq + (q - a) // each] = room.get(seq + (q - a) // each, 0) + length
    assert seen == counts and max(room.values()) <= 2048
    first_fit: list[int] = []
    for length in sorted(lengths.tolist(), reverse=True):
        at = next((k for k, r in enumerate(first_fit) if r >= length), None)
        if at is None:
            first_fit.append(2048 - length)
        else:
            first_fit[at] -= length
    assert len(room) <= 1.04 * len(first_fit) + 1


def test_pieces(docs, empty):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    own, lib = pieces.PieceCodec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = [t or "" for t in TEXTS if t is None or len(t) < 20_000] + ["".join(rng.choices(" ▁\n\tabé,.1日𝒳", k=rng.randint(0, 40))) for _ in range(2000)]
    for t in texts:
        ids = lib.encode(t)
        assert own.encode(t) == ids and own.both(t)[1] == lib.decode(ids) == own.decode(ids)
    got = {r.doc_id: r for r in pieces.digests(docs, path).collect()}
    assert got[4].ids_sha256 == hashlib.sha256(",".join(map(str, lib.encode(TEXTS[4]))).encode()).hexdigest() and got[0].n_tokens == 0
    assert pieces.digests(empty, path).count() == 0


@pytest.mark.parametrize("size", [32, 1])
def test_exact(docs, empty, size):
    rows = exact.exact_dedup(docs, size).collect()
    norm = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    texts = [(k, norm(t)) for k, t in enumerate(TEXTS)] + [(None, norm(TEXTS[6])), (6, norm(TEXTS[6]))]
    assert len(rows) == len(texts)
    for r in rows:
        same = [k for k, t in texts if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        assert r.group_size == len(same) and r.keep_id == max(k for k in same if k is not None)
    assert sum(r.kept for r in rows) == len({t for _, t in texts})
    assert exact.exact_dedup(empty).count() == 0


def kept_lines(rows):
    keys = {}
    key = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s.strip(lines.WHITE))
    for k, t in rows:
        for s in (t or "").split("\n"):
            keys.setdefault(key(s), set()).add(k)
    gone = {s: min(ks) for s, ks in keys.items() if len(s) >= 10 and len(ks) > 1}
    return {k: "\n".join(s for s in (t or "").split("\n") if gone.get(key(s), k) >= k) for k, t in rows}


def test_lines(spark, docs, empty):
    rows = list(enumerate(TEXTS))
    index = lines.LineIndex.built(docs, shards=3)
    got = {r.doc_id: r.kept_text for r in index.rewritten(docs).collect() if r.doc_id is not None}
    assert got == kept_lines(rows)
    few, rest = docs.where("doc_id < 5"), docs.where("doc_id >= 5")
    grown = lines.LineIndex.built(few, shards=3).inserted(rest.dropDuplicates(["doc_id"]))
    assert {r.doc_id: r.kept_text for r in grown.rewritten(docs.where("doc_id is not null")).collect()} == got
    back = grown.deleted(rest.select("doc_id").distinct())
    assert {r.doc_id: r.kept_text for r in back.rewritten(few).collect()} == kept_lines(rows[:5])
    assert lines.LineIndex.built(empty).rewritten(empty).count() == 0
    assert lines.deduplicated(docs).columns == docs.columns


def test_cuckoo():
    own, keys = lines.CuckooFilter.sized(2000), np.arange(1, 2001, dtype=np.uint64) * np.uint64(7919)
    assert not len(own.insert(keys)) and own.contains(keys).all()
    own = lines.CuckooFilter.loaded(own.dumped())
    own.delete(keys[:1000])
    assert own.contains(keys[1000:]).all() and own.contains(keys[:1000]).mean() < 0.01


def test_jaccard(spark, docs, empty):
    rng, rows = random.Random(5), []
    for g in range(12):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 5, 40, 120]))]
        for _ in range(6):
            own = [w if rng.random() > 0.015 else f"z{rng.randint(0, 99)}" for w in base]
            rows.append((len(rows), " ".join(own)))
    got = {r.doc_id: r for r in jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {}
    for k, t in rows:
        w = t.split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    root = {k: k for k in sets}
    for a in sets:
        for b in sets:
            if a < b and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if r == high else r for k, r in root.items()}
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == {k: (len(s), root[k]) for k, s in sets.items()}
    assert jaccard.linked(docs).count() == docs.count() and jaccard.linked(empty).count() == 0
    assert jaccard.one_of_each(docs).columns == docs.columns


def test_jaccard_hot(spark):
    """Variants that link with one text T but not with each other, in buckets dealt in parts."""
    rng, rows = random.Random(8), []
    for _ in range(30):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(44)]
        rows += [(len(rows) + k, " ".join(base)) for k in range(4)]
        rows += [(len(rows) + k, " ".join(base + [f"v{rng.randint(0, 10**6)}" for _ in range(12)])) for k in range(3)]
    got = {r.doc_id: r.component_id for r in jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string"), hot=2).collect()}
    assert got == {k: k - k % 7 for k, _ in rows}


def test_tree_loses_nothing():
    rng = np.random.default_rng(1)
    p = rng.integers(0, 6, (3000, 16))
    n = p.sum(1)
    tree = jaccard.CountTree(p, n)
    for q in range(0, 3000, 100):
        m = int(n[q])
        want = np.flatnonzero((4 * n >= 3 * m) & (3 * n <= 4 * m) & (np.minimum(p, p[q]).sum(1) >= jaccard.needed(n, m)))
        assert sorted(tree.near(p[q], m).tolist()) == want.tolist()


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 1), (7, 9)], "a long, b long")
    assert {r.node: r.component for r in graph.components(links).collect()} == {1: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7}


def test_language(spark, docs, empty):
    model = language.LanguageModel.fit(docs)
    rows = language.identified(docs.drop("score"), model).collect()
    assert len(rows) == docs.count()
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (0, 1, 2, 3, 10)} == dict.fromkeys((0, 1, 2, 3, 10), "und")
    assert language.identified(empty.drop("score"), model).count() == 0 and language.accepted(docs).columns == docs.columns
    assert language.LanguageModel.fit(empty).predict(["abc"])[0] == ["und"]


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(k, k % 2) for k in range(13)], "doc_id long, quality int")
    for model in (quality.RuleEnsemble.train(docs, labels), quality.RuleEnsemble.fit(np.zeros((0, len(quality.STATS))), np.zeros(0))):
        assert quality.accepted(docs, model).columns == docs.columns
        assert quality.with_statistics(docs).select(model.column().alias("s")).where("s is null or s < 0 or s > 1").count() == 0
    assert quality.with_statistics(empty).count() == 0


def test_quality_learns():
    rng = np.random.default_rng(2)
    x = rng.random((1500, len(quality.STATS)))
    y = ((x[:, 2] > 0.4) & (x[:, 5] < 0.8)).astype(float)
    model = quality.RuleEnsemble.fit(x[:1000], y[:1000])
    s = model.intercept + sum(w * quality.holds(x[1000:], r) for r, w in model.rules)
    assert ((s > 0) == (y[1000:] > 0)).mean() > 0.93


def test_warc(spark, docs, empty):
    rows = [(1, "http://b.org/x?b=1&a=2", "<p>" + "é" * 80), (2, None, None), (3, "http://www.a.org/", "<p>" + "é" * 80), (4, "http://a.org/", "short"), (5, "http://a.org/", "short"), (None, "http://a.org/", "WARC/1.1\r\n\r\n" * 20)]
    got = {r.page_id: r for r in warc.capture_history(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1].record_type, got[3].record_type, got[3].refers_to, got[5].record_type) == ("response", "revisit", 1, "response")
    assert all(got[k].payload_digest == hashlib.sha256((t or "").encode()).hexdigest() and got[k].payload_bytes == len((t or "").encode()) for k, _, t in rows)
    order = sorted(got.values(), key=lambda r: r.place)
    assert [r.place for r in order] == list(range(6)) and [r.urlkey for r in order] == sorted(r.urlkey for r in order)
    assert warc.capture_history(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    runs = [sorted(random.Random(k).choices(range(99), k=k)) for k in range(7)]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_chroma(spark, docs, empty):
    rng = np.random.default_rng(4)
    base = [(np.sin(np.cumsum(rng.choice([0.2, 0.35, 0.5], 40).repeat(256))) * 90 + 128).astype(np.uint8) for _ in range(6)]
    rows = [(50, base[0]), (51, base[0]), (52, np.concatenate([base[1][:1024], base[0]])), (53, base[2]), (100, base[3][:4000]), (101, base[3]), (102, base[4][:100])]
    media = spark.createDataFrame([(k, bytearray(b.tobytes())) for k, b in rows] + [(103, None)], "id long, media binary")
    got = {r.id: r for r in chroma.matched(media, "id", "media").collect()}
    assert got[51].class_id == 50 and got[50].best_class == 52 and got[50].best_offset == 4 and got[50].bit_error < 0.05
    assert got[100].best_class == 101 and got[53].n_aligned == 0 and got[102].n_windows == got[103].n_windows == 0
    assert chroma.matched(empty, "doc_id", "text").count() == 0 and chroma.matched(docs, "doc_id", "text").count() == docs.count()


def test_chroma_short_media(spark):
    rng = np.random.default_rng(6)
    a, b = (rng.integers(0, 256, n).astype(np.uint8) for n in (1500, 2303))
    near = np.concatenate([b[:-1], b[:1]])
    rows = [(50, a), (51, a), (52, b), (100, b), (53, near), (54, a[:1]), (55, a[:0])]
    got = {r.id: r for r in chroma.matched(spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in rows], "id long, media binary"), "id", "media").collect()}
    assert got[51].class_id == 50 and got[52].class_id == got[100].class_id == 52 and got[54].class_id == 54 and got[55].class_id == 55
    assert got[52].is_query and got[52].n_aligned == 1 and got[52].best_class == 53 and got[50].n_aligned == 0
    assert [got[k].n_integers for k in (50, 52, 54, 55)] == [6, 9, 1, 0] and all(got[k].n_windows == 0 for k, _ in rows)


def test_chroma_bit_errors(spark):
    """Noise, a shift by 101 samples, a short recording within a long query."""
    rng = np.random.default_rng(7)
    a, b, c, d = (rng.integers(0, 256, 9000).astype(np.uint8) for _ in range(4))
    noisy = np.clip(a + rng.normal(0, 2, len(a)), 0, 255).astype(np.uint8)
    rows = [(50, a), (51, noisy), (100, b), (101, np.concatenate([b[:101], b])), (150, c), (151, c[2603:5603]), (200, d)]
    got = {r.id: r for r in chroma.matched(spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in rows], "id long, media binary"), "id", "media").collect()}
    assert [(got[k].n_aligned, got[k].best_class) for k in (50, 100, 150, 200)] == [(1, 51), (1, 101), (1, 151), (0, None)]
    assert got[150].best_offset == -10 and all(got[k].bit_error < chroma.LIMIT for k in (50, 100, 150))


def test_chroma_search(spark, monkeypatch):
    """Blocks, parts and slices of hits against all offsets tried one by one."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 32, (4, 24), np.uint64).astype(np.uint32)
    base[:, :8] = base[0, :8]
    prints = []
    for k in range(60):
        own = base[k % 4].copy()
        for at in rng.integers(0, 24, k % 9):
            own[at] ^= np.uint32(1 << int(rng.integers(0, 32)))
        prints.append(own[int(rng.integers(0, 6)) : int(rng.integers(8, 25))] if k % 3 else own)
    prints += [base[0][:1], base[0][:3], np.full(700, base[1][3]), np.full(900, base[1][3])]
    shifted = {k: [p, p[1:]] for k, p in enumerate(prints) if k % 5 == 0 or k > 61}

    def tried(a, b):
        short = min(len(a), len(b))
        run, out = max(min(4, short), -(-short // 2)), []
        for off in range(-len(a), len(b)):
            s, e = max(0, -off), min(len(a), len(b) - off)
            bits = np.array([int(x ^ y).bit_count() for x, y in zip(a[s:e], b[s + off : e + off], strict=True)])
            if run and e - s >= run and (least := min(bits[i : i + run].sum() for i in range(e - s - run + 1)) / (32 * run)) < chroma.LIMIT:
                out.append((-int((bits == 0).sum()), float(least), abs(off), off))
        return out

    want = {}
    for q, starts in shifted.items():
        for o, b in enumerate(prints):
            if q != o and (best := min((x for a in starts for x in tried(a, b)), default=None)):
                want[q, o] = (best[3], -best[0], round(best[1], 9))
    table = spark.createDataFrame([(k, p.astype(int).tolist(), [x.astype(int).tolist() for x in shifted[k]] if k in shifted else None) for k, p in enumerate(prints)], "class_id long, fingerprint array<long>, shifted array<array<long>>")
    assert len(want) > 100
    for sizes in ((2_000_000, 2_000_000, 2, 500_000), (100, 300, 1, 50)):
        for name, value in zip(("POINTS", "INTEGERS", "PARTS", "HITS"), sizes, strict=True):
            monkeypatch.setattr(chroma, name, value)
        limits = sizes[3]
        search = chroma.Search(np.array([q for q, s in shifted.items() for _ in s]), [a for s in shifted.values() for a in s])
        got = {(q, o): (f, m, round(e, 9)) for rows in search.found(np.arange(len(prints)), prints) for q, o, f, m, e in zip(*(x.tolist() for x in rows), strict=True)}
        assert got == want, limits
    assert {(r.query, r.other): (r.offset, r.matches, round(r.bit_error, 9)) for r in chroma.aligned(table).collect()} == want
    best = {r.query: (r.n_aligned, r.best.other) for r in chroma.best_aligned(table).collect()}
    assert best == {q: (sum(k[0] == q for k in want), min((v[2], -v[1], k[1]) for k, v in want.items() if k[0] == q)[2]) for q in {k[0] for k in want}}


def test_licences(spark, docs, empty):
    own = docs.select("doc_id", "text")
    model = licences.LicenceModel.fit(own)
    got = {r.doc_id: r for r in licences.scanned(own, model).collect()}
    assert got[12].families == "MIT" and sum(r.n_licences for r in got.values()) == 1 and got[0].n_paragraphs == 0
    assert licences.scanned(empty.select("doc_id", "text"), model).count() == 0


def test_licences_hot_and_wrapped(spark):
    """Notices on the first line of many texts, and notices wrapped over lines."""
    rng = random.Random(9)
    prose = lambda: " ".join(f"w{rng.randint(0, 300)}" for _ in range(12))
    rows = [(k, ("SPDX-License-Identifier: MIT\n" if k % 3 == 0 else "") + f"{prose()}\n{prose()}") for k in range(300)]
    gpl = "/* This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version. */"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
    rows += [(300, f"{prose()}\n{gpl}\n{prose()}"), (301, f"{prose()}\n\n{bsd}\n\n{prose()}"), (302, bsd.replace("\n", "\n\n")), (303, "Released under the MIT License.\n\nReleased under the MIT License.")]
    rows += [(304, "This file is not licensed under the MIT License."), (305, gpl.replace("GNU General", "GNU Lesser General")), (306, f"{prose()}\nLicensed under CC BY-NC 4.0.\n{prose()}"), (307, "This work is licensed under the GNU General Public License, version 3."), (308, 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.'), (309, "The committee met mit der MIT; a license to fish was not granted.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_licences, r.families) for r in licences.scanned(docs, licences.LicenceModel.fit(docs)).collect()}
    assert got == {k: (1, "MIT") if k % 3 == 0 else (0, "") for k in range(300)} | {300: (1, "GPL-3.0"), 301: (1, "BSD-3-Clause"), 302: (0, ""), 303: (2, "MIT"), 304: (0, ""), 305: (1, "LGPL-3.0"), 306: (1, "CC-BY-NC-4.0"), 307: (1, "GPL-3.0"), 308: (1, "Apache-2.0"), 309: (0, "")}


SENTENCES = {
    "never released under the MIT License": "",
    "The MIT License was written in the eighties.": "",
    "No part is licensed under the GNU General Public License.": "",
    "This article compares the MIT License with others": "",
    "We do not publish this under the MIT License.": "",
    "Dual licensed under the MIT License or the Apache License, Version 2.0.": "Apache-2.0,MIT",
    "License: MIT": "MIT",
    "Licensed under GPLv3": "GPL-3.0",
    "This project is MIT licensed.": "MIT",
    "Apache 2.0 license": "Apache-2.0",
    "Released under the MIT Licence.": "MIT",
    "Licensed under GPL version 2 only": "GPL-2.0",
    "Licensed under the GNU General Public License version 2": "GPL-2.0",
    "Released under the MIT License.": "MIT",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.': "Apache-2.0",
    "Not licensed under the MIT License or the Apache License, Version 2.0.": "",
}


def test_licence_sentences(spark):
    """Denied, spoken of, dual, versions and short forms; trained on prose alone."""
    rng = random.Random(4)
    prose = spark.createDataFrame([(k, " ".join(f"w{rng.randint(0, 300)}" for _ in range(12))) for k in range(300)], "doc_id long, text string")
    rows = spark.createDataFrame(list(enumerate(SENTENCES)), "doc_id long, text string")
    got = {r.doc_id: r.families for r in licences.scanned(rows, licences.LicenceModel.fit(prose)).collect()}
    assert {s: got[k] for k, s in enumerate(SENTENCES)} == SENTENCES
