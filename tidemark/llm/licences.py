"""Operator 3: licence scans by a trained paragraph classifier.

Paragraphs are blocks between blank lines. A notice stands where a line of its block
and the words that follow (REACH at most) hold at least CONFIRM of a template's word
bigrams and the same without the line does not; templates are names of licences and
first sentences of their standard headers (fixed values below). What stands there is
predicted by a multinomial logistic regression with a lasso penalty over distinct word
bigrams and trigrams, trained on names alone and after phrases that grant (GRANTS) and on headers,
against unknown: names after and before phrases that only speak of a licence (TALK, AFTER),
denied grants (DENIALS with PARTICIPLES) and a bounded sample of the corpus's own lines (SAMPLE rows and one line of each, by hash;
distinct, and none that holds half of a template). The probability is calibrated: a
logistic curve over its log-odds is fitted on phrases held out of the training and on a
second sample of lines. A prediction counts from LEAST on, and where a template of its
own family confirms it; a block counts once for each family. Where a paragraph confirms
notices of several families, its alternatives are predicted one by one.

As CONFIRM of a template can't be had without some of its words, only texts and lines near
such a word are split into n-grams, and only those with a notice are predicted. Everything runs on built-in functions and pyspark.ml.

Null and empty texts have no licence. One row per row; other columns are not read.
"""

from __future__ import annotations

import functools
import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import QUERIES, table, written

SAMPLE = 2000
CONFIRM = 0.8
LEAST = 0.5
# Names of licences by family.
NAMES = {
    "AGPL-3.0": ["the GNU Affero General Public License", "SPDX-License-Identifier: AGPL-3.0-only"],
    "Apache-2.0": ["the Apache License, Version 2.0", "Apache 2.0 license", "SPDX-License-Identifier: Apache-2.0"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC0-1.0": ["the CC0 1.0 Universal Public Domain Dedication", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-2.0": ["the GNU General Public License version 2", "under GPLv2", "GPL version 2", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"],
    "GPL-3.0": ["the GNU General Public License", "the GNU GPL version 3", "under GPLv3", "GPL version 3", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "ISC": ["the ISC License", "SPDX-License-Identifier: ISC"],
    "LGPL-3.0": ["the GNU Lesser General Public License", "SPDX-License-Identifier: LGPL-3.0-only"],
    "MIT": ["the MIT License", "the MIT Licence", "MIT licensed", "License: MIT", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["the Mozilla Public License", "SPDX-License-Identifier: MPL-2.0"],
}
# First sentences of standard headers.
HEADERS = {
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that"],
    "GPL-3.0": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "LGPL-3.0": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License"],
}
#: Phrases of training and (after the bar) held out: before a name, those that grant and those that only speak of it; after a name, what is said of it; and what turns a participle and "under" into a denial.
GRANTS = "licensed under|available under|released under|distributed under the terms of|made available under|provided under|subject to the terms of|use of this file is governed by|you may use this work under|dual licensed under", "published under|covered by|offered under the terms of|shared under"
TALK = "this is an article about|the history of|unlike works under|compare it with|this article compares|a book on|the text of|questions about|a summary of", "a lecture on|the authors of"
AFTER = "was written in the past|was drafted by lawyers|is a permissive licence|is often chosen|has few conditions|differs from others|with others|explained", "was published long ago|is short"
DENIALS = "do not|not|never|no longer|is not|was never|no part is|nothing here is|none of this is|cannot be|neither", "nor|without being"
PARTICIPLES = "publish this|release this|license this|licensed|released|available|distributed|published|provided|offered|covered"
#: Unknown words around training notices, so that no frame of words is learnt.
AROUND = ["", "copyright the authors", "this work is", "all rights reserved", "see the file for details"]
NOTICES = {f: [*NAMES[f], *HEADERS.get(f, [])] for f in NAMES}
UNKNOWN = "unknown"
#: Tokens that follow the line where a notice starts: its words, and as many comment marks.
REACH = 2 * max(len(t.split()) for texts in NOTICES.values() for t in texts)
#: Each line with what follows it, up to a blank line.
AHEAD = r"(?dm)^(?=([^\n]*(?:(?![ \t\r]*\n[ \t\r]*\n)\s+\S+){0,%d}))" % REACH
# Function words; n-grams of these alone are no features.
STOP = "a an and any are as by for form from in is it of on or that the this to under use with without".split()


def words(column):
    return F.filter(F.split(F.lower(column), "[^a-z0-9.+-]+"), lambda w: F.length(w) > 0)


def clean(column):
    """Words without points at their ends."""
    return F.filter(F.transform(words(column), lambda w: F.btrim(w, F.lit(".+-"))), lambda w: F.length(w) > 0)


def grams(column, n: int):
    """Word n-grams of an array of words."""
    last = F.size(column) - (n - 1)
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(column, i, n), " "))).otherwise(F.array().cast("array<string>"))


def once(column, use):
    """use(column) where column is computed once and not for each mention of it."""
    return F.element_at(F.transform(F.array(column), use), 1)


def bigrams(column):
    return once(clean(column), lambda w: F.array_distinct(grams(w, 2)))


def template(notice: str) -> list[str]:
    """The distinct bigrams of a notice."""
    w = [x for x in (x.strip(".+-") for x in re.split("[^a-z0-9.+-]+", notice.lower())) if x]
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


@functools.cache
def telling() -> list[str]:
    """Words of which any text that confirms a notice contains one."""
    found = ["license", "gpl"]
    for needs in sorted(template(t) for texts in NOTICES.values() for t in texts):
        spare = len(needs) - math.ceil(CONFIRM * len(needs) - 1e-9)  # bigrams that may be missing
        left = [n for n in needs if not any(f in w for f in found for w in n.split())]
        while len(needs) - len(left) <= spare:
            parts = [w for n in left for w in n.split() if w not in STOP and len(w) > 2]
            best = max(parts, key=lambda w: (len(w), sum(w in n.split() for n in left), w))
            found.append(best)
            left = [n for n in left if not any(best in w for w in n.split())]
    return found


def mentions(column):
    """Whether the text may confirm a notice."""
    low = F.lower(column)
    found = F.lit(False)
    for w in telling():
        found = found | low.contains(w)
    return found


def shares(column):
    """The share of each notice's bigrams that the text has."""
    needs = [template(t) for texts in NOTICES.values() for t in texts]
    return once(bigrams(column), lambda has: F.array(*(F.size(F.array_intersect(has, F.array(*map(F.lit, n)))) / len(n) for n in needs)))


def starts(docs: DataFrame) -> DataFrame:
    """doc_id, block, line, paragraph: where a notice starts; the line if it holds the notice, else what follows too."""
    near = docs.where(mentions(F.col("text"))).select("doc_id", F.posexplode(F.split("text", r"\n[ \t\r]*\n")).alias("block", "own"))
    windows = F.transform(F.regexp_extract_all("own", F.lit(AHEAD), 1), lambda w, i: F.struct(i.alias("line"), w.alias("ahead")))
    near = near.where(mentions(F.col("own"))).select("doc_id", "block", F.explode(F.filter(windows, lambda w: mentions(w["ahead"]))).alias("w")).select("doc_id", "block", "w.*")
    held = near.where(F.array_max(shares(F.col("ahead"))) >= CONFIRM)
    line = F.substring_index("ahead", "\n", 1)
    rest = F.expr("substring(ahead, length(substring_index(ahead, '\\n', 1)) + 2)")
    three = F.arrays_zip(shares(F.col("ahead")).alias("all"), shares(line).alias("line"), shares(rest).alias("rest"))
    found = held.withColumn("three", three)
    alone = F.exists("three", lambda x: x["line"] >= CONFIRM)
    wrapped = F.exists("three", lambda x: (x["all"] >= CONFIRM) & (x["rest"] < CONFIRM))
    return found.where(alone | wrapped).select("doc_id", "block", "line", F.when(alone, line).otherwise(F.col("ahead")).alias("paragraph"))


def apart(rows: DataFrame) -> DataFrame:
    """Adds piece: a paragraph in which two families or more are confirmed is split between alternatives that each confirm one, with the words up to the first "under" before each."""
    families = [f for f, texts in NOTICES.items() for _ in texts]
    own = once(shares(F.col("paragraph")), lambda x: F.size(F.array_distinct(F.array_compact(F.array(*(F.when(F.get(x, F.lit(k)) >= CONFIRM, F.lit(f)) for k, f in enumerate(families)))))))
    pieces = F.filter(F.split("paragraph", r"(?i)\b(?:or|and|ou|et)\b|[;/&]"), lambda p: F.array_max(shares(p)) >= CONFIRM)
    lead = F.regexp_extract("paragraph", r"(?is)^(.*?\bunder\b)", 1)
    led = F.transform(pieces, lambda p, i: F.when(i > 0, F.concat(lead, F.lit(" "), p)).otherwise(p))
    several = F.when(own > 1, led)
    paragraphs = F.when(F.size(several) > 1, several).otherwise(F.array("paragraph"))
    return rows.select(*(c for c in rows.columns if c != "paragraph"), F.posexplode(paragraphs).alias("piece", "paragraph"))


def featured(rows: DataFrame) -> DataFrame:
    """Adds features: the distinct bigrams and trigrams of paragraph."""
    return rows.withColumn("features", once(clean(F.col("paragraph")), lambda w: F.array_distinct(F.concat(grams(w, 2), grams(w, 3)))))


def phrases(part: int) -> list[tuple[str, str]]:
    """family, paragraph: notices of the training (part 0) or those held out (1)."""
    out = []
    for family, names in NAMES.items():
        for name in names:
            spdx = name.startswith("SPDX")
            plain = name.removeprefix("under ")
            out += [(family, f"{x} {g} {plain}") for g in GRANTS[part].split("|") if not spdx for x in AROUND for _ in range(2)]
            out += [(family, f"{x} {name}") for x in AROUND for _ in range(6)]
            if not spdx:
                out += [(UNKNOWN, f"{x} {t} {plain}") for t in TALK[part].split("|") for x in AROUND[:3]]
                out += [(UNKNOWN, f"{x} {plain} {t}") for t in AFTER[part].split("|") for x in AROUND[:3]]
                out += [(UNKNOWN, f"{d} {p} under {plain}") for d in DENIALS[part].split("|") for p in PARTICIPLES.split("|")]
        out += [(family, f"{x} {h}") for h in HEADERS.get(family, []) for x in AROUND for _ in range(8)]
    return out


class LicenceModel:
    """weights: rows (feature, family, weight); intercepts, and slope and shift of the calibration."""

    def __init__(self, weights: DataFrame, families: list[str], intercepts: list[float], curve: tuple[float, float] = (1.0, 0.0)):
        self.weights, self.families, self.intercepts, self.curve = weights, families, intercepts, curve

    @classmethod
    def fit(cls, docs: DataFrame, size: int = SAMPLE) -> LicenceModel:
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, VectorAssembler

        spark = docs.sparkSession
        sampled = docs.select(F.xxhash64(F.lit(11), F.col("doc_id")).alias("h"), "text")
        top = sampled.select("h").orderBy("h").limit(2 * size).agg(F.max("h")).first()[0]
        lines = F.split(F.coalesce("text", F.lit("")), "\n")
        own = sampled.where(F.col("h") <= F.lit(top if top is not None else 0)).select("h", once(lines, lambda x: F.element_at(x, (F.pmod(F.xxhash64(F.lit(13), F.col("h")), F.size(x)) + 1).cast("int"))).alias("paragraph"))
        own = own.groupBy("paragraph").agg(F.min("h").alias("h"))
        own = written(own.where(F.array_max(shares(F.col("paragraph"))) < 0.5).select((F.pmod("h", F.lit(2)) == 0).alias("second"), "paragraph"), "sample")
        families = [UNKNOWN, *sorted(NAMES)]
        label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
        notices = [spark.createDataFrame(phrases(part), "family string, paragraph string") for part in (0, 1)]
        unknown = own.select("second", F.lit(UNKNOWN).alias("family"), "paragraph")
        training = featured(notices[0].union(unknown.where("not second").drop("second"))).withColumn("label", label).repartition(8).persist()
        vectors = CountVectorizer(inputCol="features", outputCol="vector", binary=True, minDF=5, vocabSize=4096).fit(training)
        always = {g for r in featured(notices[0].distinct()).select("features").collect() for g in r.features}
        vectors = CountVectorizerModel.from_vocabulary(sorted(always | set(vectors.vocabulary)), inputCol="features", outputCol="vector", binary=True)
        fitted = LogisticRegression(featuresCol="vector", family="multinomial", elasticNetParam=1.0, regParam=1e-3, maxIter=60).fit(vectors.transform(training))
        training.unpersist()
        matrix, shift = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
        shift = [float(shift[k]) if k < len(shift) else -10.0 for k in range(len(families))]
        rows = [(feature, families[k], float(matrix[k, j])) for j, feature in enumerate(vectors.vocabulary) for k in range(matrix.shape[0]) if abs(matrix[k, j]) > 1e-6 and not set(feature.split(" ")) <= set(STOP)]
        model = cls(spark.createDataFrame(rows, "feature string, family string, weight double"), families, shift)
        held = notices[1].union(unknown.where("second").drop("second")).select(F.monotonically_increasing_id().alias("doc_id"), F.lit(0).alias("block"), F.lit(0).alias("line"), F.lit(0).alias("piece"), "paragraph", F.col("family").alias("truth"))
        held = written(held, "held-out")
        curve = model.scored(held.drop("truth")).join(held.select("doc_id", "truth"), "doc_id").where("family <> 'unknown'")
        curve = written(curve.select("odds", (F.col("family") == F.col("truth")).cast("double").alias("label")), "curve")
        if curve.select("label").distinct().count() == 2:
            line = LogisticRegression(featuresCol="x", regParam=1e-3).fit(VectorAssembler(inputCols=["odds"], outputCol="x").transform(curve))
            model.curve = max(0.1, float(line.coefficients[0])), float(line.intercept)
        return model

    def scored(self, rows: DataFrame) -> DataFrame:
        """doc_id, block, line, piece, family, odds (log of), probability, coverage for rows of doc_id, block, line, piece, paragraph."""
        own = featured(rows)
        at = ["doc_id", "block", "line", "piece"]
        hit = own.select(*at, F.explode(F.concat("features", F.array(F.lit("")))).alias("feature")).join(F.broadcast(self.weights), "feature", "left")
        names = F.array(*map(F.lit, self.families))
        sums = F.array(*(F.sum(F.when(F.col("family") == f, F.col("weight")).otherwise(0.0)) + F.lit(b) for f, b in zip(self.families, self.intercepts, strict=True)))
        total = hit.groupBy(*at).agg(sums.alias("margins")).withColumn("top", F.array_max("margins"))
        others = F.aggregate("margins", F.lit(0.0), lambda acc, m: acc + F.exp(m - F.col("top"))) - 1
        total = total.select(*at, F.element_at(names, F.array_position("margins", F.col("top")).cast("int")).alias("family"), (-F.log(F.greatest(others, F.lit(1e-12)))).alias("odds"))
        slope, shift = self.curve
        total = total.withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(slope) * F.col("odds") + F.lit(shift)))))
        # Templates: the largest share of a template's bigrams that the paragraph has.
        best = F.array(*(F.struct(F.lit(f).alias("family"), F.array_max(F.array(*(F.size(F.array_intersect("has", F.array(*map(F.lit, template(t))))) / len(template(t)) for t in texts))).alias("share")) for f, texts in NOTICES.items()))
        share = rows.select(*at, bigrams(F.col("paragraph")).alias("has")).select(*at, F.map_from_entries(best).alias("shares"))
        return total.join(share, at).select(*at, "family", "odds", "probability", F.coalesce(F.try_element_at("shares", "family"), F.lit(0.0)).alias("coverage"))


def scanned(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """doc_id, n_paragraphs, n_licences, families (sorted, joined by commas), least_probability for every row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = model.scored(written(apart(starts(own).distinct()), "starts")).where((F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST) & (F.col("coverage") >= CONFIRM))
    found = hits.groupBy(F.col("doc_id").alias("id_"), "block", "family").agg(F.max("probability").alias("p"))
    found = found.groupBy("id_").agg(F.count("*").alias("n_licences"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.min("p").alias("least_probability"))
    rows = own.select("doc_id", F.when(F.length("text") > 0, F.regexp_count("text", F.lit(r"\n[ \t\r]*\n")) + 1).otherwise(F.lit(0)).cast("long").alias("n_paragraphs"))
    return rows.join(found, F.col("doc_id") == F.col("id_"), "left").select("doc_id", "n_paragraphs", F.coalesce("n_licences", F.lit(0)).cast("long").alias("n_licences"), F.coalesce("families", F.lit("")).alias("families"), "least_probability")


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scanned(docs, LicenceModel.fit(docs))


QUERIES["op3_licence_scan"] = op3_licence_scan
