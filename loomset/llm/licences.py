"""Licence notices found by a trained paragraph classifier and confirmed against templates.

Paragraphs are lines, and runs of lines that a wrapped notice may fill. They become sparse counts of hashed word unigrams and bigrams. A
multinomial logistic regression tells the licence families, plain text, and
licence talk of no known family apart; what it is unsure of, by a threshold
calibrated per family on held-out variants, is ``unknown``. A family is confirmed if
enough of the word pairs of one of its templates stand in the paragraph.

Main path and training are DataFrame code with Spark's own feature hashing and
regression. Paragraphs are exploded, scored and filtered in one pass; only the hits are
shuffled, to their documents, where a run of lines takes the place of its lines.

Runs are only made in texts that hold enough of a template's word pairs at all, and from
lines that have one of them, so none that could be confirmed is left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm.common import written

DIMENSIONS = 1 << 14
#: Partitions of the bounded training table, however many the corpus has.
FIT_PARTS = 8
PLAIN_EACH = 20
NONE, UNKNOWN = "none", "unknown"

# The wording of licence notices.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "Licensed under the GNU General Public License v2.0 or later.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it under the terms of the GNU Affero General Public License.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Distributed under the 3-Clause BSD License.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ],
    UNKNOWN: [
        "Licensed under the terms of the company license agreement.",
        "This material is licensed under a custom license, see the license file.",
        "Use is subject to license terms.",
        "All rights reserved.",
        "Copyright the authors. All rights reserved.",
        "Distributed under a proprietary license.",
    ],
}
#: Short notices that say their family in one pair of words, which no other text has.
TAGS = {
    "MIT": ["MIT"],
    "Apache-2.0": ["Apache-2.0"],
    "GPL": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "AGPL": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause"],
    "MPL": ["MPL-2.0"],
    "CC-BY": ["CC-BY-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0"],
    "ISC": ["ISC"],
    "Unlicense": ["Unlicense", "CC0-1.0"],
}
#: Headings, which confirm a family only as a whole paragraph.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "Apache-2.0": ["Apache License", "Apache License, Version 2.0", "Apache License Version 2.0, January 2004"],
    "GPL": ["GNU General Public License", "GNU General Public License, version 2", "GNU General Public License, version 3"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 3"],
    "AGPL": ["GNU Affero General Public License", "GNU Affero General Public License, version 3"],
    "BSD": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "The 3-Clause BSD License"],
    "MPL": ["Mozilla Public License", "Mozilla Public License Version 2.0"],
    "CC-BY": ["Creative Commons Attribution 4.0 International", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA": ["Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC-BY-NC": ["Creative Commons Attribution-NonCommercial 4.0 International"],
    "ISC": ["ISC License"],
    "Unlicense": ["The Unlicense"],
}
#: Words that stand before or after a notice.
FRAMES = [
    ("", ""),
    ("note", ""),
    ("copyright 2020 the authors", ""),
    ("", "see the license file for details"),
    ("the source code and the documentation", ""),
    ("", "all rights reserved"),
]
# End of the fixed values.


for _family, _tags in TAGS.items():
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {tag}" for tag in _tags]


def words_of(text: str | Column) -> Column:
    """Lower-cased runs of letters, digits and the signs inside names and versions."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.\-/][\p{L}\p{N}]+)*"), 0)


def pairs_of(words: str) -> Column:
    """Neighbouring words, joined."""
    return _pairs(F.col(words))


def _pairs(words: Column) -> Column:
    return F.when(
        F.size(words) > 1,
        F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b)),
    ).otherwise(F.array().cast("array<string>"))


def _hashed(rows: DataFrame) -> DataFrame:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=DIMENSIONS, binary=True).transform(rows)


def _grams(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pairs", pairs_of("words")).withColumn("grams", F.concat("words", "pairs"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _template_words(template: str) -> list[str]:
    """What ``words_of`` makes of a template."""
    return re.findall(r"[a-z0-9]+(?:[.\-/][a-z0-9]+)*", template.lower())


def _anchors(confirm: float) -> list[str]:
    """Words of which every text has one that holds ``confirm`` of some template's word pairs."""
    found: set[str] = set()
    for family, texts in TEMPLATES.items():
        for words in map(_template_words, texts if family != UNKNOWN else []):
            pairs = set(zip(words, words[1:]))
            for word in sorted(set(words), key=lambda w: (w not in found, -len(w), w)):
                if sum(1 for pair in pairs if not found & set(pair)) < confirm * len(pairs):
                    break
                found.add(word)
    return sorted(found)


def _may_be_confirmed(lines: Column, templates: Column, confirm: float) -> Column:
    """Whether the words of a text's lines, one after the other, hold enough of a template's word pairs."""
    known = sorted({" ".join(p) for f, ts in TEMPLATES.items() if f != UNKNOWN for t in ts for w in [_template_words(t)] for p in zip(w, w[1:])})
    anchors = F.array(*map(F.lit, _anchors(confirm)))
    some = F.arrays_overlap(F.flatten(lines), anchors)
    shared = _let(F.flatten(lines), lambda words: F.array_intersect(_pairs(words), F.array(*map(F.lit, known))))
    return some & _let(shared, lambda own: F.exists(templates, lambda t: F.size(F.array_intersect(own, t["pairs"])) >= t["least"]))


def _templates(confirm: float) -> Column:
    """``family``, ``words`` (their number), ``pairs`` and ``least`` (pairs to hold) of each template."""
    return F.array(
        *[
            F.struct(
                F.lit(len(words)).alias("words"),
                F.array(*map(F.lit, pairs)).alias("pairs"),
                F.lit(confirm * len(pairs) - 1e-9).alias("least"),
            )
            for family, texts in TEMPLATES.items()
            for words in map(_template_words, texts if family != UNKNOWN else [])
            for pairs in [sorted({" ".join(p) for p in zip(words, words[1:])})]
        ]
    )


def _runs(words: Column, pairs: Column, templates: Column) -> Column:
    """``first`` and ``last`` of the runs of two and more lines that may be confirmed.

    ``words`` and ``pairs`` of each line, the latter with the pair that goes over to the next
    line. A run has no line without words. Every word of a template may have a line of its own.
    """

    def of_template(t: Column) -> Column:
        return _let(F.transform(pairs, lambda p: F.array_intersect(p, t["pairs"])), lambda hits: runs_over(hits, t))

    def runs_over(hits: Column, t: Column) -> Column:
        every = F.filter(F.sequence(F.lit(0), F.size(hits) - 1), lambda i: F.size(F.get(hits, i)) > 0)
        return F.flatten(F.transform(every, lambda first: from_line(hits, t, first)))

    def from_line(hits: Column, t: Column, first: Column) -> Column:
        end = F.least(F.size(hits) - 1, first + t["words"] - 1)
        ends = F.when(end > first, F.sequence(first + 1, end)).otherwise(F.array().cast("array<int>"))
        good = F.filter(
            ends,
            lambda e: ((F.size(F.get(hits, e)) > 0) | (F.size(F.get(hits, e - 1)) > 0))
            & (F.size(F.array_distinct(F.flatten(F.slice(hits, first + 1, e - first + 1)))) >= t["least"])
            & F.forall(F.slice(words, first + 1, e - first + 1), lambda w: F.size(w) > 0),
        )
        return F.transform(good, lambda e: F.struct(first.alias("first"), e.alias("last")))

    return F.array_distinct(F.flatten(F.transform(templates, of_template)))


def paragraphs(docs: DataFrame, key: str, text: str, confirm: float = 0.6) -> DataFrame:
    """``key``, ``doc`` (a number of the row), ``first``, ``last`` and ``words`` of each line of a text that has a letter or digit, and of runs of lines.

    ``first`` and ``last`` are numbers of lines, from 0. Runs are those of which a template may have ``confirm`` of its word pairs.
    Lines are taken apart into words once; all else works on those.
    """
    lines = F.col("lines")
    none = F.array().cast("array<string>")
    over = lambda words: F.transform(
        words,
        lambda w, i: F.when(F.size(w) > 0, _pairs(F.concat(w, F.slice(F.coalesce(F.get(words, i + 1), none), 1, 1)))).otherwise(none),
    )
    run = lambda r: F.struct(
        r["first"].alias("first"), r["last"].alias("last"), F.flatten(F.slice(lines, r["first"] + 1, r["last"] - r["first"] + 1)).alias("words")
    )
    runs = _let(over(lines), lambda pairs: F.transform(_runs(lines, pairs, _templates(confirm)), run))
    alone = F.transform(lines, lambda words, i: F.struct(i.alias("first"), i.alias("last"), words.alias("words")))
    wrapped = (F.size(lines) > 1) & _may_be_confirmed(lines, _templates(confirm), confirm)
    return (
        # Rows are numbered before they are exploded.
        docs.select(
            F.col(key).alias("key"),
            F.monotonically_increasing_id().alias("doc"),
            F.transform(F.split(F.col(text), r"\r?\n"), words_of).alias("lines"),
        )
        .select("key", "doc", F.explode(F.when(wrapped, F.concat(alone, runs)).otherwise(alone)).alias("p"))
        .select("key", "doc", "p.*")
        .filter(F.size("words") > 0)
    )


class LicenceModel:
    """A fitted regression with its families' thresholds."""

    def __init__(self, model: LogisticRegressionModel, families: list[str], thresholds: list[float]):
        self.model, self.families, self.thresholds = model, families, thresholds


def _notices(spark: SparkSession) -> DataFrame:
    """Notices in several frames and cut short at either end; a hash holds a third of them out, but no title."""
    rows = [
        (not any((before, after)) and text in TITLES.get(family, []), family, " ".join(part for part in (before, " ".join(kept), after) if part))
        for family, texts in TEMPLATES.items()
        for text in [*texts, *TITLES.get(family, [])]
        for before, after in FRAMES
        for words in [text.split()]
        for kept in ([words, words[1:], words[:-1]] if len(words) > 4 else [words])
    ]
    return spark.createDataFrame(rows, "taught boolean, family string, paragraph string")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", plain_docs: int = 500) -> LicenceModel:
    """Train on the notices above and on the paragraphs of about ``plain_docs`` documents of the corpus.

    Those are chosen by a hash of their keys; of their first ``PLAIN_EACH``
    paragraphs those are plain that have no word that notices turn on.
    """
    spark = docs.sparkSession
    notices = _notices(spark)
    talk = r"(?i)licen[sc]|copyright|warrant|redistribut|\bgnu\b|apache|creative commons|public domain|rights reserved"
    candidates = docs.filter(F.col(text).isNotNull())
    share = min(1.0, plain_docs / max(1, candidates.count()))
    plain = (
        candidates.filter(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < max(1, int(share * 1_000_000)))
        .select(F.explode(F.slice(F.split(F.col(text), r"\r?\n"), 1, PLAIN_EACH)).alias("paragraph"))
        .filter(~F.col("paragraph").rlike(talk))
        .select(F.lit(False).alias("taught"), F.lit(NONE).alias("family"), "paragraph")
    )
    families = [NONE, *TEMPLATES]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    rows = written(
        _hashed(_grams(notices.union(plain).repartition(FIT_PARTS).withColumn("words", words_of("paragraph"))))
        .select(
            number.cast("double").alias("label"),
            "features",
            F.when(F.col("taught"), 1).otherwise(F.pmod(F.xxhash64("paragraph"), F.lit(3))).alias("fold"),
        ),
        "licence-fit",
    )
    regression = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=40, tol=1e-4)
    model = regression.fit(rows.filter("fold != 0"))
    sure = vector_to_array("probability")[F.col("label").cast("int")]
    right = model.transform(rows.filter("fold = 0")).filter("prediction = label").groupBy("label").agg(
        F.percentile_approx(sure, 0.05, 10_000).alias("low")
    )
    low = {int(r["label"]): r["low"] for r in right.collect()}
    thresholds = [max(0.3, 0.7 * low.get(i, 0.7)) for i in range(len(families))]
    return LicenceModel(model, families, thresholds)


def scan(
    docs: DataFrame, model: LicenceModel, key: str = "doc_id", text: str = "text", confirm: float = 0.6, least: float = 0.8
) -> DataFrame:
    """Paragraphs that speak of a licence: ``key``, ``paragraph_no``, ``family``, ``predicted``, ``probability``, ``template_share``, ``confirmed``, ``lines``.

    A paragraph is a line (``paragraph_no`` from 0), or a run of ``lines`` lines from that one if only
    together they are confirmed; lines of such a run that aren't confirmed are left to it. Lines
    without a letter or digit end runs. Of runs of one family that overlap the one with
    the largest share stays.

    A paragraph speaks of one if the probabilities of all families together
    reach ``least``. ``predicted`` is the most probable family; ``family`` is the same, or
    ``unknown`` if it is less probable than its threshold or no template of it has
    ``confirm`` of its word pairs in the paragraph (of a title, all pairs and no other). Null and empty texts have no paragraphs. Rows that
    repeat a key give their paragraphs each.
    """
    families = F.array(*map(F.lit, model.families))
    thresholds = F.array(*map(F.lit, model.thresholds))
    scored = model.model.transform(
        _hashed(_grams(paragraphs(docs, key, text, confirm)).select("key", "doc", "first", "last", "pairs", "grams"))
    )
    scored = scored.withColumn("sure", vector_to_array("probability"))
    hits = scored.filter((F.col("prediction") != 0) & (F.get("sure", F.lit(0)) <= 1 - least)).select(
        "key",
        "doc",
        "first",
        "last",
        "pairs",
        F.get(families, F.col("prediction").cast("int")).alias("predicted"),
        F.get(thresholds, F.col("prediction").cast("int")).alias("threshold"),
        F.array_max("sure").alias("probability"),
    )
    share = F.lit(0.0)
    for family, texts in TEMPLATES.items():
        if family != UNKNOWN:
            of_template = [_share(t) for t in texts] + [_share(t, whole=True) for t in TITLES[family]]
            share = F.when(F.col("predicted") == family, F.greatest(*of_template)).otherwise(share)
    found = hits.withColumn("template_share", share).withColumn(
        "confirmed", (F.col("template_share") >= confirm) & (F.col("probability") >= F.col("threshold"))
    )
    found = found.filter((F.col("first") == F.col("last")) | F.col("confirmed"))
    columns = ["first", "last", "predicted", "probability", "template_share", "confirmed"]
    of_doc = found.groupBy("doc").agg(F.first("key").alias("key"), F.collect_list(F.struct(*columns)).alias("all"))
    return of_doc.select("key", F.explode(_settled(F.col("all"))).alias("p")).select("key", "p.*").select(
        F.col("key").alias(key),
        F.col("first").alias("paragraph_no"),
        F.when(F.col("confirmed"), F.col("predicted")).otherwise(UNKNOWN).alias("family"),
        "predicted",
        "probability",
        "template_share",
        "confirmed",
        (F.col("last") - F.col("first") + 1).alias("lines"),
    )


def _settled(hits: Column) -> Column:
    """One document's hits, without runs that a confirmed line or a better run stands for, and without lines that runs stand for."""
    alone = F.filter(hits, lambda h: h["first"] == h["last"])
    sure = F.filter(alone, lambda h: h["confirmed"])
    overlap = lambda a, b: (a["first"] <= b["last"]) & (b["first"] <= a["last"])
    same = lambda a, b: overlap(a, b) & (a["predicted"] == b["predicted"])
    runs = F.filter(hits, lambda h: (h["first"] < h["last"]) & ~F.exists(sure, lambda s: same(s, h)))
    ranked = F.array_sort(
        F.transform(
            runs,
            lambda h: F.struct((-h["template_share"]).alias("a"), (h["last"] - h["first"]).alias("b"), h["first"].alias("c"), h.alias("h")),
        )
    )
    none = F.filter(hits, lambda h: F.lit(False))
    best = F.aggregate(
        ranked, none, lambda kept, r: F.when(F.exists(kept, lambda k: same(k, r["h"])), kept).otherwise(F.concat(kept, F.array(r["h"])))
    )
    return F.concat(F.filter(alone, lambda h: h["confirmed"] | ~F.exists(best, lambda b: overlap(b, h))), best)


def _share(template: str, whole: bool = False) -> Column:
    """How many of a template's word pairs a paragraph has, as a share; ``whole``: 1 for all pairs and no other, else 0."""
    words = _template_words(template)
    pairs = F.array(*map(F.lit, dict.fromkeys(" ".join(p) for p in zip(words, words[1:]))))
    shared = F.size(F.array_intersect(pairs, F.col("pairs")))
    if whole:
        return F.when((shared == F.size(pairs)) & (F.size(F.array_distinct("pairs")) == shared), 1.0).otherwise(0.0)
    return shared / F.size(pairs)
