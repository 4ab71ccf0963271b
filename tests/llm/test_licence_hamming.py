import random

import pytest
from pyspark.sql import functions as F

from loomset.llm import hamming, licences


@pytest.fixture(scope="module")
def model(documents):
    return licences.fit(documents)


def scanned(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("family", F.lit("mine"))
    return {(r.doc_id, r.paragraph_no): r for r in licences.scan(df, model).collect()}


def test_notices_in_the_documents_are_found_and_nothing_else(spark, model, documents):
    want = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL",
    }
    lines = {
        (r.doc_id, n): want[line] for r in documents.collect() for n, line in enumerate(r.text.split("\n")) if line in want
    }
    got = {(r.doc_id, r.paragraph_no): r.family for r in licences.scan(documents, model).collect()}
    assert lines and got == lines


def test_families_unknown_licences_and_plain_text(spark, model):
    got = scanned(
        spark,
        model,
        [
            "plain words about the weather\nThis project is licensed under the terms of the MIT license.\nmore",
            "Licensed under the Frobnicate Public Contract, see the license file.",
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
            "the trees and the house and the morning",
        ],
    )
    assert got[(0, 1)].family == "MIT" and got[(0, 1)].confirmed and 0 < got[(0, 1)].probability <= 1
    assert all(r.family == "unknown" and not r.confirmed for k, r in got.items() if k[0] == 1)
    assert got[(2, 0)].family == "BSD"
    assert not [k for k in got if k[0] == 3 or k in ((0, 0), (0, 2))]


MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD = """BSD 3-Clause License

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""


def test_wrapped_notices_titles_and_tags(spark, model):
    narrow = "\n".join("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS".split())
    apart = "you can redistribute it and/or modify\n\nit under the terms of the GNU\n\nLesser General Public License"
    texts = ["first line\n" + MIT, BSD.replace("\n", "\r\n"), GPL, "// SPDX-License-Identifier: MIT\nint main", "SPDX-License-Identifier: BSD-3-Clause"]
    got = scanned(spark, model, [*texts, narrow, apart, MIT + "\n\n" + GPL, "This is not like the MIT License of old"])
    sure = {k: (r.family, r.lines) for k, r in got.items() if r.confirmed}
    assert {k: v[0] for k, v in sure.items()} == {
        **{(0, 1): "MIT", (0, 5): "MIT", (1, 0): "BSD", (1, 2): "BSD", (2, 0): "GPL", (3, 0): "MIT", (4, 0): "BSD"},
        **{(5, 0): "Apache-2.0", (7, 0): "MIT", (7, 4): "MIT", (7, 11): "GPL"},
    }
    assert sure[(0, 5)][1] == 3 and sure[(1, 2)][1] == 2 and sure[(2, 0)][1] == 4 and sure[(0, 1)][1] == 1
    # The lines of a run are left to it.
    assert not [k for k in got if k[0] in (0, 2) and k not in sure and k[1] in (6, 7, 1, 2, 3)]


def test_odd_texts(spark, model, odd_docs, no_docs):
    assert licences.scan(odd_docs, model).collect() == []
    assert licences.scan(no_docs, model).collect() == []
    long = "wort " * 300_000 + "\nReleased under the MIT License.\n\n"
    got = scanned(spark, model, [None, "", "\n\n", "!!!", long, "Released under the MIT License."])
    assert {k: r.family for k, r in got.items()} == {(4, 1): "MIT", (5, 0): "MIT"}


def test_a_corpus_without_text_still_gives_a_model(no_docs):
    assert licences.fit(no_docs).families[0] == licences.NONE


def near(rows, queries, k):
    out = []
    for q, asked in queries:
        ranked = sorted((bin((asked ^ code) & (2**64 - 1)).count("1"), key) for key, code in rows if code is not None and key is not None)
        out += [(q, n + 1, key, d) for n, (d, key) in enumerate(ranked[:k])]
    return sorted(out)


def searched(spark, rows, queries, **options):
    schema = "key long, code long, distance long, rank string"
    make = lambda some: spark.createDataFrame([(*r, 0, "x") for r in some], schema)
    got = hamming.top_k(make(rows), make(queries), **options)
    return sorted((r.query, r["rank"], r.key, r.distance) for r in got.collect())


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def test_nearest_of_clustered_codes(spark):
    draw = random.Random(8)
    middles = [draw.getrandbits(64) for _ in range(6)]
    rows = []
    for i in range(600):
        code = draw.choice(middles)
        for _ in range(draw.randint(0, 14)):
            code ^= 1 << draw.randrange(64)
        rows.append((i, signed(code)))
    rows += [(1000 + i, rows[0][1]) for i in range(40)]
    queries = rows[::90] + [(5000, signed(draw.getrandbits(64)))]
    assert searched(spark, rows, queries, k=7) == near(rows, queries, 7)


def test_few_rows_ties_nulls_and_repeats(spark):
    rows = [(1, 0), (2, 0), (2, 0), (3, -1), (4, 1), (5, 2), (None, 0), (6, None)]
    queries = [(1, 0), (9, -1), (8, None)]
    assert searched(spark, rows, queries, k=10) == near(rows, queries[:2], 10)
    assert searched(spark, rows, queries, k=2) == near(rows, queries[:2], 2)
    assert searched(spark, [], queries) == [] and searched(spark, rows, []) == []


def test_narrow_codes(spark):
    draw = random.Random(9)
    rows = [(i, draw.getrandbits(20)) for i in range(80)]
    assert searched(spark, rows, rows[:3], k=5, bits=20) == near(rows, rows[:3], 5)


def test_sign_codes(spark):
    df = spark.createDataFrame([([0.5, -1.0, 2.0],), ([],), (None,), ([None, 1.0],), ([-0.0] * 63 + [3.0],)], "v array<float>")
    assert [r[0] for r in df.select(hamming.sign_code("v")).collect()] == [5, 0, None, 2, -(2**63)]
