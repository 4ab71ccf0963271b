import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomset.llm import packing, queries

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ids_of():
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def tokens_of(rows, width=2):
    return [(row, key, np.array(ids, f"<u{width}").tobytes(), len(ids)) for row, (key, ids) in enumerate(rows)]


def packed(spark, rows, **options):
    tokens = spark.createDataFrame(tokens_of(rows), "row long, key string, ids binary, n_tokens long")
    return packing.pack(tokens, **options).collect()


def check(pieces, documents, capacity, width=2):
    """Every id in one piece, no gaps in documents or sequences, sequences full but for powers of two."""
    by_key, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length > 0 and p.doc_tokens == len(documents[p.key])
        by_key[p.key].append((p.start, np.frombuffer(p.ids, f"<u{width}").tolist()))
        by_sequence[p.sequence_id].append((p.offset, p.length))
        assert len(by_key[p.key][-1][1]) == p.length
    assert {k: [i for _, ids in sorted(v) for i in ids] for k, v in by_key.items()} == documents
    sizes = []
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        sizes.append(end)
    assert sorted(by_sequence) == list(range(len(sizes)))
    short = [s for s in sizes if s != capacity]
    assert all(s < capacity and s & (s - 1) == 0 for s in short) and len(short) == len(set(short))
    return sizes


@pytest.mark.parametrize(
    "demand",
    [{}, {1: 1}, {1: 1000}, {64: 7}, {33: 10}, {40: 3, 24: 5}, {n: n % 7 for n in range(1, 65)}, {n: 10**9 + n for n in range(5, 60)}],
)
def test_patterns_cut_what_is_wanted(demand):
    wanted = np.zeros(64, np.int64)
    for length, n in demand.items():
        wanted[length - 1] = n
    columns, times = packing.patterns(wanted, 64)
    lengths = np.arange(1, 65)
    assert (columns @ times == wanted).all() and (lengths @ columns <= 64).all() and (times > 0).all()
    fills = (lengths @ columns).tolist()
    assert fills == sorted(fills, reverse=True)


def test_patterns_are_near_the_best():
    """Random lengths: within a hundredth of the bound that no packing beats. Two lengths: the known optimum."""
    demand = np.bincount(np.random.default_rng(1).integers(1, 200, 50_000), minlength=257)[1:]
    _, times = packing.patterns(demand, 256)
    assert times.sum() <= 1.01 * (np.arange(1, 257) @ demand) / 256 + 2
    two = np.zeros(10, np.int64)
    two[[2, 3]] = 200, 100  # two threes and a four fill ten
    assert packing.patterns(two, 10)[1].sum() == 100


def test_ids_are_the_librarys(ids_of):
    rng = random.Random(5)
    signs = [lambda: rng.randrange(1, 0x3000), lambda: rng.randrange(32, 127), lambda: 32, lambda: 0x301, lambda: rng.randrange(0x1F300, 0x1F700)]
    texts = ["".join(chr(rng.choice(signs)()) for _ in range(50)) for _ in range(400)]
    texts += ["", " ", "a <|endoftext|> b<|startoftext|>", "x\x1cy\x0bz\x85w  v", "DON'T don't İI ΑΣ", " \n lead", "é" * 3000]
    encoder = packing._Encoder(open(FILE, encoding="utf-8").read(), 2, 2)
    for part in (texts[:100], texts[90:], texts[::-1]):
        got = encoder.encode(pa.array([*part, None]))
        assert [np.frombuffer(g, "<u2").tolist() for g in got.to_pylist()] == [ids_of(t) for t in [*part, None]]


def test_the_query_packs_all_documents(spark, sf_dir, documents, ids_of):
    import zlib

    want = {r.doc_id: ids_of(r.text) for r in documents.collect()}
    tokens = packing.encode(spark, documents, FILE, end=2)
    pieces = packing.pack(tokens, rows_per_slice=30)
    sizes = check(pieces.collect(), want, 4096)
    assert sum(sizes) == sum(map(len, want.values()))
    for r in queries.op11_pattern_packing(spark, sf_dir).collect():
        ids = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and r.doc_tokens == len(want[r.doc_id])


@pytest.mark.parametrize(("capacity", "unit"), [(64, 4), (64, 1), (64, 64), (128, 8)])
def test_lengths_of_all_kinds(spark, capacity, unit):
    rng = random.Random(capacity + unit)
    lengths = [*range(1, 140), *[50] * 120, *[1] * 30, 64 * 9, 1000, 128]
    documents = {f"d{i}": [rng.randrange(1 << 16) for _ in range(n)] for i, n in enumerate(lengths)}
    sizes = check(packed(spark, documents.items(), capacity=capacity, unit=unit, rows_per_slice=25), documents, capacity)
    assert sum(s == capacity for s in sizes) == sum(lengths) // capacity


@pytest.mark.parametrize("lengths", [[1], [64], [3], [64, 64], [63, 1], [65], [1] * 200, [33] * 9, []])
def test_few_documents(spark, lengths):
    documents = {f"d{i}": [i + 1] * n for i, n in enumerate(lengths)}
    check(packed(spark, documents.items(), capacity=64, unit=4), documents, 64)


def test_most_documents_stay_whole(spark):
    """Only those of dissolved sequences are cut: far fewer than when laid end to end."""
    rng = random.Random(3)
    documents = {f"d{i}": [7] * rng.randrange(1, 250) for i in range(3000)}
    pieces = packed(spark, documents.items(), capacity=256, unit=1)
    check(pieces, documents, 256)
    end_to_end = sum(map(len, documents.values())) // 256
    assert len(pieces) - len(documents) < 0.2 * end_to_end


def test_sequences_are_the_pieces_in_order(spark):
    documents = {f"d{i}": list(range(i, i + 40)) for i in range(20)}
    tokens = spark.createDataFrame(tokens_of(documents.items()), "row long, key string, ids binary, n_tokens long")
    pieces = packing.pack(tokens, capacity=64, unit=4)
    told = defaultdict(list)
    for p in sorted(pieces.collect(), key=lambda p: (p.sequence_id, p.offset)):
        told[p.sequence_id] += documents[p.key][p.start : p.start + p.length]
    got = {r.sequence_id: np.frombuffer(r.ids, "<u2").tolist() for r in packing.sequences(pieces).collect()}
    assert got == told


def test_odd_documents(spark, odd_docs, no_docs, ids_of):
    tokens = packing.encode(spark, odd_docs, FILE, end=2)
    pieces = packing.pack(tokens).collect()
    want = defaultdict(int)
    for r in odd_docs.collect():
        want[r.doc_id] += len(ids_of(r.text))
    got = defaultdict(int)
    for p in pieces:
        got[p.key] += p.length
    assert got == want
    full = sum(want.values()) // 4096
    assert len({p.sequence_id for p in pieces if p.sequence_id < full}) <= full
    empty = packing.pack(packing.encode(spark, no_docs, FILE, end=2))
    assert empty.collect() == [] and packing.sequences(empty).collect() == []
    with pytest.raises(ValueError, match="divide"):
        packing.pack(tokens, capacity=100, unit=16)
    with pytest.raises(ValueError, match="fit"):
        packing.encode(spark, odd_docs, FILE, end=1 << 16)


def test_wide_ids(spark):
    rows = [("a", [1 << 20, 5, 1 << 31]), ("b", [9] * 10)]
    tokens = spark.createDataFrame(tokens_of(rows, 4), "row long, key string, ids binary, n_tokens long")
    check(packing.pack(tokens, capacity=8, unit=1, width=4).collect(), dict(rows), 8, 4)
    crcs = {r[0] for r in tokens.select(packing.ids_crc32("ids", 4)).collect()}
    assert crcs == {r[0] for r in tokens.select(F.crc32("ids")).collect()}
