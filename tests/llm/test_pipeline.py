"""Each stage of the corpus pipeline against a plain Python version, and run() against the stages."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import language, quality
from tidemark.llm.common import table, written

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\v\f\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def stages(spark):
    """documents, then each stage's rows."""
    docs = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], SF), name))
    return docs


def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def test_columns(stages):
    assert all(d.schema.names == stages[0].schema.names for d in stages[:-1])


def test_language_stage(stages):
    before, after = texts(stages[0]), texts(stages[1])
    model = language.LanguageModel.fit(language.training_rows(stages[0]))
    rows = language.identified(stages[0], model).collect()
    assert set(after) == {r.doc_id for r in rows if r.lang_pred != "und" and r.score >= language.LEAST_SHARE}
    assert all(before[k] == t for k, t in after.items()) and all(any(c.isalpha() for c in t) for t in after.values())


def test_quality_stage(spark, stages):
    before, after = texts(stages[1]), texts(stages[2])
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect() if r.doc_id in before and r.quality is not None}
    right = [(k in after) == (q == 1) for k, q in labels.items()]
    assert set(after) <= set(before) and all(before[k] == t for k, t in after.items())
    assert len(right) > 20 and sum(right) >= 0.95 * len(right)
    assert 0 < quality.THRESHOLD < 1


def test_line_stage(stages):
    before, after = texts(stages[2]), texts(stages[3])
    holders = defaultdict(set)
    for k, t in before.items():
        for line in t.split("\n"):
            holders[line.strip(SPACE).translate(FOLD)].add(k)
    want = {}
    for k, t in before.items():
        keys = [(line, holders[key], len(key)) for line in t.split("\n") for key in [line.strip(SPACE).translate(FOLD)]]
        want[k] = "\n".join(line for line, own, n in keys if n < 10 or len(own) < 2 or min(own) == k)
    assert after == want and want != before


def test_jaccard_stage(spark, stages):
    """On the lines' stage and near and exact copies of a part of it (line dedup leaves few)."""
    copies = stages[3].where("doc_id % 7 < 2").withColumn("doc_id", F.col("doc_id") + 100_000).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit(" one word more"))).otherwise(F.col("text")))
    docs = written(stages[3].union(copies), "copies")
    before, after = texts(docs), texts(dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, SF))
    sets = {}
    for k, t in before.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", t.translate(FOLD))
        sets[k] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    lead = {k: k for k in sets}

    def top(k):
        while lead[k] != k:
            k = lead[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                lead[y] = x
    assert after == {k: t for k, t in before.items() if top(k) == k} and len(after) < len(before) - 20


def test_packing_stage(spark, stages):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want, total = {}, 0
    for k, t in texts(stages[4]).items():
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start : start + 2048]
            want[k, piece] = (start, len(own), zlib.crc32(own.tobytes()))
    rows = stages[5].collect()
    assert len(rows) == len(want) and {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= math.ceil(total / 2048) + 2
    digest = lambda rows: hashlib.sha256(str(sorted((r.doc_id, r.piece, r.length, r.sequence_id, r.offset) for r in rows)).encode()).hexdigest()
    assert digest(corpus_pipeline.run(spark, SF).collect()) == digest(rows)
