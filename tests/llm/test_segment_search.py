import random

import numpy as np
import pytest
from plans import plan_of

from loomset.llm import hamming


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def distance(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1")


def near(rows, queries, k):
    out = []
    for q, asked in queries:
        ranked = sorted((distance(asked, code), key) for key, code in rows)
        out += [(q, n + 1, key, d) for n, (d, key) in enumerate(ranked[:k])]
    return sorted(out)


def searched(spark, rows, queries, **options):
    kind = "string" if isinstance(rows[0][0], str) else "long"
    make = lambda some: spark.createDataFrame(some, f"key {kind}, code long")
    got = hamming.top_k(make(rows), make(queries), **options)
    return sorted((r.query, r["rank"], r.key, r.distance) for r in got.collect())


def clustered(draw, count, most=12):
    middles = [draw.getrandbits(64) for _ in range(5)]
    rows = []
    for i in range(count):
        code = draw.choice(middles) if draw.random() < 0.7 else draw.getrandbits(64)
        for _ in range(draw.randint(0, most)):
            code ^= 1 << draw.randrange(64)
        rows.append((i, signed(code)))
    return rows


@pytest.fixture
def small(monkeypatch):
    """Several shards and blocks of queries, batches of few queries."""
    monkeypatch.setattr(hamming, "_CODES", 60)
    monkeypatch.setattr(hamming, "_QUERIES", 4)
    monkeypatch.setattr(hamming, "_AT_ONCE", 16)


def test_probes_are_neither_stored_nor_broadcast(spark, monkeypatch):
    rows = clustered(random.Random(1), 300)
    plans, written = [], hamming.written

    def noted(df, label):
        plans.append((label, plan_of(df)))
        return written(df, label)

    monkeypatch.setattr(hamming, "written", noted)
    assert searched(spark, rows, rows[::60], k=4) == near(rows, rows[::60], 4)
    rounds = [plan for label, plan in plans if label == "hamming-found"]
    assert rounds and not [plan for plan in rounds if "Join" in plan or "Broadcast" in plan]
    assert "hamming-index" not in dict(plans)


def test_shards_and_blocks(spark, small):
    rows = clustered(random.Random(2), 400)
    # One code of many rows, and a query of it that comes twice.
    rows += [(1000 + i, rows[3][1]) for i in range(30)]
    queries = [*rows[::45], rows[3], rows[3], (5000, signed(random.Random(3).getrandbits(64)))]
    assert searched(spark, rows, queries, k=6) == near(rows, queries, 6)


def test_fewer_rows_than_asked_for(spark, small):
    rows = clustered(random.Random(4), 90, most=30)
    assert searched(spark, rows, rows[:3], k=100) == near(rows, rows[:3], 100)


def test_one_value_in_most_segments(spark, small):
    draw = random.Random(5)
    rows = [(i, draw.getrandbits(9)) for i in range(300)]
    queries = [*rows[:5], (9000, signed(draw.getrandbits(64)))]
    assert searched(spark, rows, queries, k=5) == near(rows, queries, 5)


def test_keys_of_text(spark, small):
    rows = [(f"k{key}é", code) for key, code in clustered(random.Random(6), 150)]
    assert searched(spark, rows, rows[:4], k=5) == near(rows, rows[:4], 5)


@pytest.mark.parametrize("at_once", [1, 50, 1 << 17])
def test_a_radius_meets_what_no_earlier_one_met(monkeypatch, at_once):
    monkeypatch.setattr(hamming, "_AT_ONCE", at_once)
    rng = np.random.default_rng(7)
    codes = rng.integers(0, 2**64, 200, np.uint64)
    codes[100:] = codes[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100, np.uint64))
    segments = hamming._segments(64, 200)
    index = hamming._Index(codes, segments)
    asked = codes[::40]
    full = np.bitwise_count(asked[:, None] ^ codes)
    least = np.min([np.bitwise_count(hamming._values(asked[:, None] ^ codes, s)) for s in segments], axis=0)
    for radius in range(4):
        # The bound asks for all segments; every code within it that is this near in its nearest segment, once.
        bound = np.array([64, 64, 40, 33, len(segments) * (radius + 1)])
        who, place, far = index.search(asked, bound, radius, 3)
        want = [
            (q, int(p), int(full[q, p]))
            for q in range(5)
            for p in sorted(np.flatnonzero((least[q] == radius) & (full[q] <= bound[q])), key=lambda p: (full[q, p], p))[:3]
        ]
        assert list(zip(who.tolist(), place.tolist(), far.tolist())) == want
