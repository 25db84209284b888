"""Operator 13: phrase collocations by partitioned mining (SON).

The corpus is split into a few shards, and each shard is mined completely at the
support's share: a phrase with the global support reaches it in one shard at least.
Mining counts 64-bit hashes of phrases, level by level: one and two words first, then
three and four words where all shorter phrases inside are frequent. Equal hashes can only
raise a count, so no candidate is lost. The same sums give a hash's count over all
shards, and what has not the support there is dropped too. Sets of hashes are sent to
tasks as bitmaps of fixed size (with more hashes than it has room for a bitmap lets more
phrases pass, never fewer).

One task for each frequent phrase, the first that saw it, gives the hashes of its parts
and of the phrases inside it. Joins of these with the counts by hash tell which phrases
can be among the first of their language; all that tie with the last stay. A last pass
counts these and the parts of their cuts as words, exactly and over all rows, so that its
rows grow with the tasks, not with tasks times frequent phrases. Scores, covers and ranks
come from these exact counts. Two phrases of one hash would be told apart there, but could
change which phrases are counted: with 10^10 different phrases the chance is about
3 in 100,000 that such a pair touches any of the first 8000 phrases or their parts.

Tasks hold one bounded buffer of hashes or counts; a frequent phrase is summed within
tasks before rows are dealt. Null texts count as empty, null languages as `und`,
repeated rows as rows; a language without words or phrases gives no rows, nor does an
empty table. Other columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import add, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ORACLE, QUERIES, mix64, slices, table, written

LONGEST = 4
SUPPORT = 30
TOP = 2000
SHARDS = 2
#: Bits of a bitmap of hashes (16 MB), whatever the input's size.
BITS = 27
#: Hashes, words and phrases that a task holds before it passes their counts on.
BUFFER, WORDS, PHRASES = 4_000_000, 300_000, 800_000
#: Separators become full stops, which no word holds, and tabs spaces; A-Z are lower-cased.
PLAIN = bytes.maketrans(b",;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"......... abcdefghijklmnopqrstuvwxyz")


class Hashes(dict):
    """64-bit hash by word, up to WORDS of them."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= WORDS:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word) | 1
        return h


def tokens(texts: list[bytes | None]) -> list[bytes]:
    """The words of the texts with b"." between pieces and texts."""
    return b".".join([t or b"" for t in texts]).translate(PLAIN).replace(b".", b" . ").split()


def phrase_hashes(words: list[bytes], known: Hashes, lang: str) -> list[np.ndarray]:
    """For 1 to LONGEST words the hash of the phrase that starts at each token; 0 where it would cross a separator."""
    seed = np.uint64(known[lang.encode() + b" "])
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    inner = h != known[b"."]
    one = np.where(inner, mix64(h ^ seed) | np.uint64(1), 0)
    out = [one]
    for k in range(1, LONGEST):
        longer = np.zeros_like(one)
        if len(one) > k:
            first, last = out[-1][: len(one) - k], one[k:]
            longer[: len(one) - k] = np.where((first != 0) & (last != 0), mix64(first * np.uint64(0x9E3779B97F4A7C15) + last) | np.uint64(1), 0)
        out.append(longer)
    return out


def passed(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether a hash (0: none) has both its places marked: that of its upper and that of its lower bits."""
    out = h != 0
    for at in (h >> np.uint64(64 - BITS), h & np.uint64((1 << BITS) - 1)):
        out &= ((bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return out


def in_languages(batches):
    """Slices of the batches (text as bytes, lang) as pairs of a language and its texts."""
    for batch in batches:
        for part in slices(batch, 0):
            own: dict[str, list] = {}
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                own.setdefault(lang, []).append(text)
            yield from own.items()


def spoken(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").cast("binary").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))


def mined(docs: DataFrame, support: int, shards: int, longer: np.ndarray | None = None) -> DataFrame:
    """h, n, home, word: hashes that are locally frequent in a shard and have the support in all, with their count in all and the first task that saw them. Of words and of two words; with the bitmap of those, of three and four words."""
    sent = docs.sparkSession.sparkContext.broadcast(longer) if longer is not None else None

    def count(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        known, held, size = Hashes(), ([], []), 0

        def flushed():
            for word, own in enumerate(held):
                h, n = np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                for a in range(0, len(h), 1 << 17):
                    b = slice(a, a + (1 << 17))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h[b]), 2 * task + word, np.int32)), pa.array(h[b].view(np.int64)), pa.array(n[b].astype(np.int64))], ["at", "h", "n"])
                own.clear()

        for lang, texts in in_languages(batches):
            one, two, three, four = phrase_hashes(tokens(texts), known, lang)
            if sent is None:
                new = [two[two != 0]]
                held[1].append(one[one != 0])
                size += len(held[1][-1])
            else:
                ok = passed(sent.value, two)
                ok3 = (three != 0) & ok
                ok3[:-1] &= ok[1:]
                ok4 = (four != 0) & ok3
                ok4[:-1] &= ok3[1:]
                new = [three[ok3], four[ok4]]
            held[0].extend(new)
            size += sum(map(len, new))
            if size > BUFFER:
                yield from flushed()
                size = 0
        yield from flushed()

    local = -(-support // shards)
    rows = spoken(docs).mapInArrow(count, "at int, h long, n long")
    shard = F.shiftright("at", 1) % shards
    sums = [F.sum(F.when(shard == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(shards)]
    rows = rows.groupBy("h").agg(*sums, F.min("at").alias("at"))
    frequent = reduce(or_, (F.col(f"n{k}") >= local for k in range(shards)))
    n = reduce(add, (F.col(f"n{k}") for k in range(shards)))
    return rows.where(frequent & (n >= support)).select("h", n.alias("n"), F.shiftright("at", 1).alias("home"), (F.col("at") % 2 == 1).alias("word"))


def bitmap(hashes: DataFrame) -> np.ndarray:
    """A bitmap with the places of the hashes' upper and lower BITS bits; 2^(BITS - 15) rows of 4 KB at most come to the driver."""
    places = F.explode(F.array(F.shiftrightunsigned("h", 64 - BITS), F.col("h").bitwiseAND((1 << BITS) - 1)))
    rows = hashes.select(places.alias("place")).select((F.col("place") + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    out = np.zeros((1 << (BITS - 15), 4096), np.uint8)
    for r in rows:
        out[r.bucket - 1] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def linked(docs: DataFrame, homes: np.ndarray, at_home: bool = True) -> DataFrame:
    """lang, h, cuts, inner: phrases of the bitmap with the hashes of their two parts at each cut and of the phrases inside them. With at_home the bitmap is of hashes salted by the one task that shall give them."""
    sent = docs.sparkSession.sparkContext.broadcast(homes)

    def link(batches):
        from pyspark import TaskContext

        known, seen, salt = Hashes(), set(), salted(TaskContext.get().partitionId()) if at_home else np.uint64(0)
        for lang, texts in in_languages(batches):
            levels = phrase_hashes(tokens(texts), known, lang)
            for k in range(2, LONGEST + 1):
                h = levels[k - 1]
                at = np.flatnonzero(passed(sent.value, np.where(h != 0, h ^ salt, 0)))
                own, first = np.unique(h[at], return_index=True)
                new = np.fromiter((x not in seen for x in own.tolist()), bool, len(own))
                if len(seen) > PHRASES:  # what comes twice is dropped later
                    seen.clear()
                seen.update(own.tolist())
                own, at = own[new], at[first[new]]
                cuts = [levels[size - 1][at + start] for cut in range(1, k) for start, size in ((0, cut), (cut, k - cut))]
                inner = [levels[size - 1][at + start] for size in range(2, k) for start in range(k - size + 1)]
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * len(x)), pa.array((np.stack(x, 1) if x else np.zeros(0, np.uint64)).reshape(-1).view(np.int64))) for x in (cuts, inner)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(own.view(np.int64)), *lists], ["lang", "h", "cuts", "inner"])

    return spoken(docs).mapInArrow(link, "lang string, h long, cuts array<long>, inner array<long>")


def salted(task):
    """What a task's number changes in a hash: both of its places in a bitmap."""
    return np.uint64((task & 0xFFFFF) << 44 ^ task & 0xFFFFF)


def chosen(docs: DataFrame, frequent: DataFrame, top: int) -> tuple[DataFrame, DataFrame]:
    """By hash, the phrases that can be among the first of their language (h), and these with the parts of their cuts (h). Ties of score and count all stay."""
    home = F.col("home").cast("long").bitwiseAND(0xFFFFF)
    phrases = frequent.where("not word")
    links = linked(docs, bitmap(phrases.select(F.col("h").bitwiseXOR(F.shiftleft(home, 44)).bitwiseXOR(home).alias("h"))))
    links = written(links.join(phrases.select("h", F.col("n").alias("a")), "h").dropDuplicates(["h"]), "links")
    lost = written(phrases.join(links, "h", "left_anti").select("h"), "lost")
    if not lost.isEmpty():  # the files were dealt otherwise than before
        more = linked(docs, bitmap(lost), at_home=False).join(phrases.select("h", F.col("n").alias("a")), "h").join(lost, "h", "left_semi").dropDuplicates(["h"])
        links = written(links.unionByName(more), "links")
    of = lambda side, name: frequent.select(F.col("h").alias(side), F.col("n").alias(name))
    cuts = links.select("lang", "h", "a", F.posexplode(F.expr("transform(sequence(0, size(cuts) - 2, 2), i -> struct(cuts[i] AS left, cuts[i + 1] AS right))")).alias("k", "cut"))
    cuts = cuts.select("lang", "h", "a", "cut.left", "cut.right").join(of("left", "l"), "left").join(of("right", "r"), "right")
    lowest = cuts.groupBy("lang", "h", "a").agg(F.min(score("a", "l", "r")).alias("score"))
    cover = links.select("a", F.explode("inner").alias("h")).groupBy("h").agg(F.max("a").alias("longer"))
    left = lowest.join(cover, "h", "left").where(uncovered("a"))
    best = written(first(left, top, F.rank(), [F.desc("score"), F.desc("a")], "h").select("h"), "best")
    return best, best.union(links.join(best, "h", "left_semi").select(F.explode("cuts").alias("h"))).distinct()


def counted(docs: DataFrame, frequent: np.ndarray, support: int) -> DataFrame:
    """lang, phrase, words, f, h: exact counts of the words and phrases of the bitmap that have the support, and of all words (phrase null); the hash is null but for phrases of two words or more."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches):
        known, own = Hashes(), {}

        def flushed():
            for (lang, k), found in own.items():
                rows = list(found.items())
                for at in range(0, len(rows), 1 << 16):
                    part = rows[at : at + (1 << 16)]
                    n, h = len(part), pa.nulls(len(part), pa.int64())
                    if k > 1:
                        h = phrase_hashes(b" . ".join([p for p, _ in part]).split(), known, lang)[k - 1]
                        h = pa.array(h[h != 0].view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([p for p, _ in part], pa.binary()).cast(pa.string()), pa.array([k] * n, pa.int32()), pa.array([c for _, c in part], pa.int64()), h], ["lang", "phrase", "words", "f", "h"])
            own.clear()

        for lang, texts in in_languages(batches):
            words = tokens(texts)
            levels = phrase_hashes(words, known, lang)
            own.setdefault((lang, 0), Counter())[None] += int((levels[0] != 0).sum())
            for k in range(1, LONGEST + 1):
                at = np.flatnonzero(passed(sent.value, levels[k - 1])).tolist()
                own.setdefault((lang, k), Counter()).update(b" ".join(words[a : a + k]) for a in at)
            if sum(map(len, own.values())) > PHRASES:
                yield from flushed()
        yield from flushed()

    rows = spoken(docs).mapInArrow(count, "lang string, phrase string, words int, f long, h long")
    return rows.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"), F.max("h").alias("h")).where((F.col("words") == 0) | (F.col("f") >= support))


def score(a: str, left: str, right: str):
    return F.expr(f"(CAST(2000000 AS DECIMAL(7, 0)) * CAST({a} AS DECIMAL(19, 0))) DIV (CAST({left} AS DECIMAL(19, 0)) + CAST({right} AS DECIMAL(19, 0)))").cast("long")


def uncovered(a: str):
    """Whether no longer phrase has four fifths of the count."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    return F.col("longer").isNull() | (100 * wide("longer") < 80 * wide(a))


def scored(counts: DataFrame, best: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score: each phrase of the best hashes with its lowest-scoring cut, and without those that a longer one covers."""
    known = counts.where("words between 1 and 3").select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part"))
    phrases = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("own"), "h")
    cuts = phrases.join(best, "h", "left_semi").select("lang", "phrase", "words", "a", "own", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", F.expr("array_join(slice(own, 1, k), ' ')").alias("left"), F.expr("array_join(slice(own, k + 1, words), ' ')").alias("right"))
    of = lambda side, name: known.select("lang", F.col("part").alias(side), F.col("of_part").alias(name))
    cuts = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    lowest = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score("a", "l", "r").alias("score"), "k", "l", "r")).alias("cut"))
    inside = phrases.where("words > 2").select("lang", "a", "own", "words", F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
    inside = inside.select("lang", "a", F.explode(F.expr("transform(sequence(1, words - size + 1), i -> array_join(slice(own, i, size), ' '))")).alias("phrase"))
    cover = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = lowest.join(cover, ["lang", "phrase"], "left").where(uncovered("a"))
    return left.select("lang", "phrase", "words", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))


def first(rows: DataFrame, top: int, place, order: list, key: str) -> DataFrame:
    """The first rows of each language: of many small parts first, then of fewer, so that no task sorts a language."""
    for parts in (4096, 64):
        within = Window.partitionBy("lang", "part_").orderBy(*order)
        rows = rows.withColumn("part_", F.pmod(F.xxhash64(key), F.lit(parts))).withColumn("rank", place.over(within)).where(F.col("rank") <= top).drop("rank", "part_")
    return rows.withColumn("rank", place.over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of docs (text, lang)."""
    short = written(mined(docs, support, shards), "short")
    longer = written(mined(docs, support, shards, bitmap(short.select("h"))), "longer")
    best, needed = chosen(docs, short.union(longer), top)
    counts = written(counted(docs, bitmap(needed), support), "phrases")
    rows = first(scored(counts, best), top, F.row_number(), [F.desc("score"), F.desc("a"), F.asc("phrase")], "phrase")
    n = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return rows.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES["op13_phrase_collocations"] = op13_phrase_collocations
ORACLE["op13_phrase_collocations"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 5)) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
u AS (SELECT lang, phrase, k, a, ws, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT u.lang, u.phrase, u.a, u.cut, l.f AS l, r.f AS r, CAST(2000000 AS HUGEINT) * u.a // (l.f + r.f) AS score
  FROM u JOIN f l ON l.lang = u.lang AND l.phrase = array_to_string(u.ws[:u.cut], ' ') AND l.k = u.cut
  JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(u.ws[u.cut + 1:], ' ') AND r.k = u.k - u.cut),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM s),
kept AS (SELECT b.* FROM b WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.phrase <> b.phrase
  AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * CAST(c.a AS HUGEINT) >= 80 * CAST(b.a AS HUGEINT))),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT o.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
"""
