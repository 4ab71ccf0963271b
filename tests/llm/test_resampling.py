import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loomset.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def features(text, orders):
    found = words(text)
    return [" ".join(found[i : i + k]) for k in range(1, orders + 1) for i in range(len(found) - k + 1)]


def plain(docs, target, orders=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for text in texts for f in features(text, orders)) for texts in ([d for _, d in docs], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)}
    rows = []
    for key, text in docs:
        found = features(text, orders)
        weight = math.floor(sum(gain[bucket(f)] for f in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    eligible = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = percent * len(eligible) // 100
    out = [(*r[:4], n if n <= drawn else None) for n, r in enumerate(eligible, 1)]
    return sorted(out + [(*r[:4], None) for r in rows if r[4] < min_words], key=repr)


def got(spark, docs, target, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in resampling.resample(df, wanted, **options).collect()), key=repr)


def texts(n, seed=1):
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "naïve", "Ünï", "x1", "42", "日本", "to", "the", "of", "q" * 300, "é" * 200, "z" * 9, "twelveletter"]
    signs = [" ", ", ", "\n", "\x00", "-", " ", "_"]
    return [(i, "".join(rng.choice(vocabulary) + rng.choice(signs) for _ in range(rng.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"orders": 3, "buckets": 50}, {"percent": 100}, {"min_words": 0, "percent": 37, "seed": 5}, {"percent": 0}])
def test_like_counting_one_by_one(spark, options):
    docs = texts(120)
    target = ["alpha naïve 42", "日本 of the", "", None, "unseen words only"]
    assert got(spark, docs, target, **options) == plain(docs, target, **options)


def test_ties_and_copies(spark, monkeypatch):
    """Copies share key and score and are ranked one by one; more of them than one task numbers at a time."""
    monkeypatch.setattr(resampling, "COPIES_PER_CHUNK", 7)
    docs = [(5, "one two three " * 9)] * 40 + [(5, "four five six " * 9)] * 3 + [(i, "one two " * 20) for i in range(20)]
    docs += [(None, "one two " * 20), (None, None), (None, "")]
    for percent in (30, 66, 100):
        assert got(spark, docs, ["one"], percent=percent) == plain(docs, ["one"], percent=percent)


def test_odd_documents(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    benchmark = spark.createDataFrame([("lang breit",), (None,)], "text string")
    out = resampling.resample(odd_docs, benchmark, percent=50, min_words=3)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain(docs, ["lang breit", None], percent=50, min_words=3)
    assert resampling.resample(no_docs, benchmark).collect() == []
    nothing = benchmark.limit(0)
    assert sorted((tuple(r) for r in resampling.resample(odd_docs, nothing, percent=50, min_words=3).collect()), key=repr) == plain(
        docs, [], percent=50, min_words=3
    )


def test_drawn_documents_keep_their_columns(spark, odd_docs):
    benchmark = spark.createDataFrame([("lang",)], "text string")
    drawn = resampling.draw(odd_docs, benchmark, percent=50, min_words=1)
    ranks = resampling.resample(odd_docs, benchmark, percent=50, min_words=1)
    keys = {r.doc_id for r in ranks.filter("rank is not null").collect()}
    assert drawn.columns == odd_docs.columns and {r.doc_id for r in drawn.collect()} == keys


def test_crcs_of_stretches():
    rng = np.random.default_rng(0)
    stream = rng.integers(0, 256, 40_000).astype(np.uint8)
    lengths = np.concatenate([rng.integers(0, 40, 3000), [256, 257, 5000, 0, 8, 8, 9, 16, 17]])
    starts = rng.integers(0, 30_000, len(lengths))
    starts[100:1100], lengths[100:1100] = 77, 11  # the same bytes many times
    want = [zlib.crc32(stream[a : a + n].tobytes()) for a, n in zip(starts, lengths)]
    assert resampling.crcs(stream, starts, lengths).tolist() == want
    assert resampling.crcs(stream, starts[:0], lengths[:0]).tolist() == []


def test_settings_of_the_session_stay(spark, odd_docs):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 7777)
    try:
        resampling.resample(odd_docs, odd_docs).collect()
        assert spark.conf.get(name) == "7777"
    finally:
        spark.conf.set(name, before)
