import re
from collections import defaultdict

import pytest

from loomset.llm import mixing


def plain_targets(sizes, weights, budget):
    """Water filling by the rule: whoever is above twice its size stops there, the rest share again."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s else b""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    target, free, left = {}, set(order), budget
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= above
    return target


def test_targets_and_what_is_taken(documents):
    got = mixing.fair_queue(documents, rows_per_slice=20).collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in documents.collect()}
    assert {r.doc_id: r.size for r in got} == size
    sources, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sources[r.source] += r.size
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    budget = 1.5 * sum(sources.values())
    want = plain_targets(sources, (3, 1, 2), budget)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sources[r.source]
        assert 0 <= r.copies <= 2
    for s in sources:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]
    assert budget - max(largest.values()) <= sum(taken.values()) <= budget


def test_slices_do_not_change_the_mix(documents, rows_of):
    columns = ("doc_id", "copies", "target")
    whole = rows_of(mixing.fair_queue(documents), *columns)
    assert rows_of(mixing.fair_queue(documents.repartition(7), rows_per_slice=9), *columns) == whole
    assert rows_of(mixing.fair_queue(documents, seed="other"), *columns) != whole


def test_odd_documents(odd_docs, no_docs, rows_of):
    got = mixing.fair_queue(odd_docs)
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    assert all(r.copies == 0 for r in rows if r.size == 0)
    assert {r.source for r in rows} == {"a", "b", "é", None}
    assert sum(r.size * r.copies for r in rows) <= 1.5 * sum(r.size for r in rows)
    assert mixing.fair_queue(no_docs).collect() == []
    assert mixing.mix(no_docs).collect() == []
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() > 0


def test_only_empty_texts(docs_of):
    rows = mixing.fair_queue(docs_of([(1, "", "a"), (2, None, "b")])).collect()
    assert [(r.size, r.target, r.copies) for r in rows] == [(0, 0.0, 0)] * 2


def test_repeated_documents_come_as_often_as_taken(documents):
    copies = {r.doc_id: r.copies for r in mixing.fair_queue(documents).collect()}
    seen = defaultdict(int)
    for r in mixing.mix(documents).collect():
        seen[r.doc_id] += 1
    assert dict(seen) == {i: n for i, n in copies.items() if n}
    assert 2 in copies.values() and 0 in copies.values()
