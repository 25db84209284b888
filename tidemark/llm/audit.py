"""Operator 12: filter interaction audit by recursive enumeration of filter orders.

Each document gets a mask of the filters that it fails; documents are counted by part
and mask (at most 2^filters cells a part). A recursive query walks over the orders: a
row is a mask with a prefix of filters and the bits applied so far, and each level adds
a letter that the prefix lacks and says whether such documents are kept, removed here,
or fail what is applied here but went before. These few rows (prefixes times masks,
whatever the input's size) are joined to the cells on the mask and summed by part.

Null texts count as empty, null parts as the empty string. Rows with equal texts are
copies of the smallest doc_id; repeated rows of that id stay, and a null id is neither
a copy nor an original. Of several labels of an id the largest counts. An empty table
gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ORACLE, QUERIES, removed, table, written

SPACE = r"[\x20\x09-\x0D]"
COPY = "E"
#: With six filters the walk has 125,248 rows, which Spark's recursion takes and a broadcast bears.
MOST = 6


def text_filters(text: str = "text") -> dict[str, Column]:
    """The conditions under which a text fails: few words, repeated words, capital letters, symbols."""
    t = F.col(text)
    words = F.size("words__")
    return {
        "A": words < 200,
        "B": 100 * F.size(F.array_distinct("words__")) < 50 * words,
        "C": 100 * F.length(F.regexp_replace(t, "[^A-Z]+", "")) > 2 * F.length(t),
        "D": t.rlike("[#$%&*|]"),
    }


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, quality, toxic for each row of docs (doc_id, text, source); bit 16 is the copy's."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    own = own.withColumn("words__", F.array_remove(F.split("text", f"{SPACE}+"), ""))
    bits = sum((F.when(fails, F.lit(1 << k)).otherwise(0) for k, fails in enumerate(text_filters().values())), F.lit(0))
    rows = written(own.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), bits.alias("bits")), "masks")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("quality"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    out = rows.join(first, "digest", "left").join(known, "doc_id", "left")
    copy = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    flag = lambda c: F.coalesce(c, F.lit(0))
    out = out.select("part", (F.col("bits") + F.when(copy, F.lit(16)).otherwise(0)).alias("mask"), flag("quality").alias("quality"), flag("toxic").alias("toxic"))
    out.written_path = rows.written_path
    return out


def cells(rows: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents, and those with the labels, of each part that fail exactly the mask's filters."""
    return rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("quality").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic"))


def walked(masks: DataFrame, letters: str) -> DataFrame:
    """mask, prefix, step, letter, bit, kept, removed, redundant: what each prefix of filters does to a mask at its last letter."""
    assert len(letters) <= MOST
    spark = masks.sparkSession
    ways = [(applied, c, 1 << k) for applied in range(1 << len(letters)) for k, c in enumerate(letters) if not applied >> k & 1]
    ways = spark.createDataFrame(ways, "applied int, letter string, bit int")
    return spark.sql(
        """
        WITH RECURSIVE walk(mask, prefix, step, letter, bit, applied, kept, removed, redundant) AS (
          SELECT CAST(mask AS INT), '', 0, '', 0, 0, true, false, false FROM {masks}
          UNION ALL
          SELECT w.mask, concat(w.prefix, n.letter), w.step + 1, n.letter, n.bit, w.applied | n.bit,
            w.mask & (w.applied | n.bit) = 0,
            w.mask & w.applied = 0 AND w.mask & n.bit <> 0,
            w.mask & w.applied <> 0 AND w.mask & n.bit <> 0
          FROM walk w JOIN {ways} n ON n.applied = w.applied
        )
        SELECT mask, prefix, step, letter, bit, kept, removed, redundant FROM walk WHERE step > 0
        """,
        masks=masks,
        ways=ways,
    )


def audited(counts: DataFrame, letters: str) -> DataFrame:
    """part, filter_order, step and the counts of each order's step, for cells of part, mask, n, good, toxic."""
    walk = walked(counts.select("mask").distinct(), letters)
    when = lambda flag, n: F.sum(F.when(F.col(flag), F.col(n)).otherwise(0)).alias
    # The walk's rows are bounded by the number of filters.
    steps = counts.join(F.broadcast(walk), "mask").groupBy("part", "prefix", "step", "letter").agg(when("kept", "n")("kept"), when("removed", "n")("removed"), when("redundant", "n")("redundant"), F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("unique_fails"), when("removed", "good")("good_lost"), when("removed", "toxic")("toxic_lost"))
    steps = written(steps, "steps")
    orders = steps.where(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    orders = orders.withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
    # A prefix stands for the orders that begin with it.
    alike = F.expr(f"factorial({len(letters)} - step)")
    shares = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * alike).alias("shapley"))
    return orders.join(steps, ["part", "prefix", "step"]).join(shares, ["part", "letter"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the four text filters and the copy filter over docs (doc_id, text, source) and labels (doc_id, quality, toxic)."""
    rows = marked(docs, labels)
    counts = written(cells(rows), "cells")
    removed(rows)
    return audited(counts, "ABCD" + COPY)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES["op12_filter_audit"] = op12_filter_audit
ORACLE["op12_filter_audit"] = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
f AS (SELECT doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d, coalesce(first < doc_id, false) AS e FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT f.*, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM f LEFT JOIN l ON f.doc_id = l.doc_id),
x(letter) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT p.letter || q.letter || r.letter || s.letter || t.letter AS filter_order FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.letter, q.letter, r.letter, s.letter, t.letter])) = 5),
fails AS (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda y: CASE y WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END) AS own FROM m),
g AS (SELECT part, own, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, own),
z AS (SELECT part, filter_order, s.step, filter_order[s.step] AS letter, n, good, toxic, own,
    len(list_filter(own, lambda y: contains(filter_order[:s.step - 1], y))) > 0 AS before, list_contains(own, filter_order[s.step]) AS here
  FROM g, o, (SELECT unnest(range(1, 6)) AS step) s),
h AS (SELECT part, filter_order, step, letter, sum(CASE WHEN NOT before AND NOT here THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT before AND here THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN before AND here THEN n ELSE 0 END) AS redundant, sum(CASE WHEN own = [letter] THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT before AND here THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT before AND here THEN toxic ELSE 0 END) AS toxic_lost
  FROM z GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM h
"""
