import os
import random
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.llm import exact_dedup, near_dup
from loomset.llm.components import components


def sets_of(rows, width):
    out = []
    for i, text in rows:
        words = (text or "").encode().lower().split()
        n = max(1, len(words) - width + 1) if words else 0
        out.append((i, frozenset(tuple(words[k : k + width]) for k in range(n))))
    return out


def plain_components(rows, width, percent):
    """Component by key, comparing every pair."""
    sets = sets_of(rows, width)
    parent = {i: i for i, _ in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in parent}, {i: len(s) for i, s in sets}


def near(docs, **options):
    return {r[0]: tuple(r)[1:] for r in near_dup.near_duplicates(docs, **options).collect()}


def test_components_of_the_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    want, sizes = plain_components(rows, 5, 80)
    got = near(documents)
    assert {i: g[1] for i, g in got.items()} == want
    assert {i: g[0] for i, g in got.items()} == sizes
    assert all(g[2] == (i == g[1]) for i, g in got.items())


def test_a_large_bucket_of_near_copies_loses_no_link(spark, docs_of, monkeypatch):
    # Copies with a few changed words each: some are linked with no centre of their buckets.
    monkeypatch.setattr(near_dup, "RIGHT_BLOCK", 16)
    monkeypatch.setattr(near_dup, "LEFT_BLOCK", 8)
    draw = random.Random(3)
    base = [f"w{n}" for n in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(draw.randint(1, 5)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    got = near(docs_of([(i, t, "a") for i, t in rows]), width=4)
    want, _ = plain_components(rows, 4, 80)
    assert {i: g[1] for i, g in got.items()} == want
    assert len(set(want.values())) > 1


def test_buckets_whose_orders_name_one_centre_stay_open(spark):
    rows = [(3, [1, 1, 1]), (3, [1, 2, 1]), (4, [1, 2, 3]), (4, [2, 2, 3]), (5, [1, 2, 3]), (2, [1, 1, 1])]
    df = spark.createDataFrame(rows, "size long, centres array<long>")
    told = [r[0] for r in df.select(near_dup._has_untold_pairs()).collect()]
    assert told == [True, False, False, True, True, False]


def test_odd_documents_are_near_nothing_or_their_equals(odd_docs, no_docs, rows_of):
    got = rows_of(near_dup.near_duplicates(odd_docs), "doc_id", "component_id", "kept")
    assert got == sorted(
        [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (6, 6, True)]
        + [(7, 6, False), (8, 8, True), (None, None, False), (None, None, False)],
        key=repr,
    )
    assert near_dup.near_duplicates(no_docs).collect() == []
    kept = near_dup.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r[0] or 0 for r in kept.select("doc_id").collect()) == [0, 0, 1, 2, 3, 4, 6, 6, 8]


def test_a_repeated_key_with_other_texts(docs_of, rows_of):
    text = " ".join(f"w{n}" for n in range(60))
    docs = docs_of([(1, "quite something else here today", "a"), (1, text, "a"), (2, text + " end", "a")])
    assert rows_of(near_dup.near_duplicates(docs), "doc_id", "component_id") == [(1, 1), (1, 1), (2, 1)]


def test_a_repeated_key_takes_no_other_text_along(docs_of, rows_of):
    text = " ".join(f"w{n}" for n in range(60))
    docs = docs_of([(1, text, "a"), (7, text + " end", "a"), (7, "quite something else here today", "a"), (7, None, "a")])
    kept = near_dup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text") == sorted([(1, text), (7, "quite something else here today"), (7, None)], key=repr)


def test_near_copies_that_share_a_key_leave_one(docs_of):
    text = " ".join(f"w{n}" for n in range(60))
    docs = docs_of([(3, text, "a"), (3, text + " end", "a"), (3, text.upper(), "a"), (5, text + " last", "a")])
    got = near_dup.near_duplicates(docs).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(3, 3), (5, 3)} and sum(r.kept for r in got) == 1
    assert [r.doc_id for r in near_dup.drop_near_copies(docs).collect()] == [3]


def test_sketches_tell_high_similarities(spark):
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 2**64, 1100, np.uint64)
    rows = []
    for shared in (1000, 950, 900, 850):
        a, b = pool[:1000], pool[1000 - shared : 2000 - shared]
        sketch = [near_dup.odd_sketch(near_dup.samples(np.unique(s))).tolist() for s in (a, b[:1000])]
        rows.append((len(set(a) & set(b)) / len(set(a) | set(b)), *sketch))
    df = spark.createDataFrame(rows, "truth double, a array<bigint>, b array<bigint>")
    for truth, told in df.select("truth", near_dup.similarity(near_dup.differing_bits("a", "b"))).collect():
        assert abs(truth - told) < 0.15


def test_bands_find_pairs_at_the_threshold():
    draw = np.random.default_rng(2)
    for _ in range(200):
        pool = draw.integers(0, 2**64, 900, np.uint64)
        keys = [set(near_dup.band_keys(near_dup.samples(np.unique(s)))) for s in (pool[:800], pool[100:])]
        assert keys[0] & keys[1]


def test_long_chains_are_one_component(spark):
    links = [(i, i + 1) for i in range(100)] + [(200, i) for i in range(201, 230)] + [(300, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {got[i] for i in range(101)} == {0}
    assert {got[i] for i in range(200, 230)} == {200}
    assert 300 not in got


def exact(docs, **options):
    df = exact_dedup.exact_dedup(docs, **options)
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=repr)


def test_odd_documents_are_equal_to_their_equals(odd_docs, no_docs, rows_of):
    got = exact(odd_docs)
    plain = [g for g in got if g[0] not in (6, None)]
    assert plain == [(1, 2, 3, False), (2, 2, 3, True), (3, 3, 1, True), (4, 5, 2, False), (5, 5, 2, True), (7, 7, 1, True), (8, 8, 1, True)]
    # Repeated rows: one of them stays.
    assert sorted(g for g in got if g[0] == 6) == [(6, 6, 3, False), (6, 6, 3, True)]
    assert [g for g in got if g[0] is None] == [(None, 2, 3, False), (None, 6, 3, False)]
    assert exact(no_docs) == []
    kept = exact_dedup.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert rows_of(kept, "doc_id") == [(2,), (3,), (5,), (6,), (7,), (8,)]


def test_equal_digests_of_different_texts_stay_apart(docs_of):
    docs = docs_of([(1, "ab", "a"), (2, "cd", "a"), (3, "ab", "a"), (4, "cd", "a"), (5, "xyz", "a"), (6, "cd", "a")])
    got = exact(docs, digest=lambda text: F.length(text).cast("string"))
    assert got == [(1, 3, 2, False), (2, 6, 3, False), (3, 3, 2, True), (4, 6, 3, False), (5, 5, 1, True), (6, 6, 3, True)]


def test_a_part_of_a_table_is_taken_as_it_is(documents):
    some = documents.filter("doc_id < 10")
    assert len(exact(some)) == 10


def test_files_beside_those_that_were_read_do_not_count(spark, tmp_path):
    table = str(tmp_path / "table")
    for row in [(1, "x"), (2, "x"), (3, "x")]:
        spark.createDataFrame([row], "doc_id long, text string").coalesce(1).write.mode("append").parquet(table)
    files = {spark.read.parquet(f).first().doc_id: f for f in spark.read.parquet(table).inputFiles()}
    some = spark.read.parquet(files[1], files[2])
    want = [(1, 2, 2, False), (2, 2, 2, True)]
    assert exact(some) == want
    assert [r.doc_id for r in exact_dedup.drop_copies(some).collect()] == [2]
    brace = "{" + ",".join(files[i].rsplit("/", 1)[1] for i in (1, 2)) + "}"
    assert exact(spark.read.option("pathGlobFilter", brace).parquet(table)) == want
    assert [g[2] for g in exact(spark.read.parquet(files[1], files[1]))] == [2, 2]
    assert exact_dedup.files_of(spark.read.parquet(table))[1].endswith("/table")
    with pytest.raises(ValueError):
        exact(some, state=str(tmp_path / "state"))


def test_later_files_meet_the_state_of_earlier_ones(spark, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    rows = lambda *r: spark.createDataFrame(r, "doc_id long, text string").coalesce(1)
    rows((1, "x"), (2, "y")).write.parquet(table)
    assert exact(spark.read.parquet(table), state=state) == [(1, 1, 1, True), (2, 2, 1, True)]
    rows((3, "x")).write.mode("append").parquet(table)
    assert exact(spark.read.parquet(table), state=state) == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True)]


def test_a_later_file_may_be_older(spark, tmp_path):
    table, state = tmp_path / "table", str(tmp_path / "state")
    rows = lambda *r: spark.createDataFrame(r, "doc_id long, text string").coalesce(1)
    rows((1, "x"), (2, "y")).write.parquet(str(table))
    assert len(exact(spark.read.parquet(str(table)), state=state)) == 2
    first = set(table.glob("*.parquet"))
    rows((3, "x"), (4, "z")).write.mode("append").parquet(str(table))
    for added in set(table.glob("*.parquet")) - first:
        os.utime(added, (time.time() - 30 * 86_400,) * 2)
    want = [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True), (4, 4, 1, True)]
    assert exact(spark.read.parquet(str(table)), state=state) == want


def test_several_batches_agree_with_one(spark, documents, tmp_path):
    path = str(tmp_path / "docs")
    documents.repartition(6).write.parquet(path)
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    for i, text in rows:
        groups[text].append(i)
    want = sorted(((i, max(g), len(g), i == max(g)) for g in groups.values() for i in g), key=repr)
    assert exact(spark.read.parquet(path), files_per_batch=2) == want
