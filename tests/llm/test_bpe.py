import random

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from loomset.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(bpe.read_ranks(PATH))


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )


def encoded(merges, text):
    words = regex.findall(public_tokenizers.PATTERN, text)
    return merges.encode(words).values.tolist() if words else []


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(merges, reference, text):
    assert encoded(merges, text) == reference.encode_ordinary(text)


def test_words_of_random_tokens_and_long_runs(merges, reference):
    draw = random.Random(5)
    names = [n.decode("utf8", "ignore") for n in draw.sample(sorted(merges.ranks), 4000)]
    texts = ["".join(draw.choices(names, k=6)) for _ in range(1500)]
    texts += ["a" * 10_001, "ab" * 5_000, " " * 999, "\n\t" * 500, "aaaa" * 7 + "b", "漢字" * 300]
    for text in texts:
        assert encoded(merges, text) == reference.encode_ordinary(text)


def test_a_merge_into_a_lower_rank_comes_first():
    # "ab" joins with "a" into a token of lower rank, before the second "ab" may be formed.
    ranks = {bytes([b]): 100 + b for b in range(256)} | {b"ab": 50, b"aba": 3, b"bab": 60, b"abab": 70}
    own = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    table = bpe.Merges(ranks)
    for text in ("ababab", "abab", "babab", "aabab", "abababababa"):
        assert table.replay([text.encode()]).values.tolist() == own._encode_single_piece(text)


def test_columns_there_and_back(spark, odd_docs, no_docs):
    tokenizer = bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    docs = odd_docs.withColumnRenamed("ids", "old")
    got = tokenizer.decode(tokenizer.encode(docs))
    assert got.columns == [c for c in docs.columns if c != "text"] + ["ids", "decoded"]
    texts = sorted((r.text or "").encode() for r in docs.collect())
    assert sorted(bytes(r.decoded) for r in got.collect()) == texts
    assert tokenizer.decode(tokenizer.encode(no_docs.drop("ids"))).collect() == []


def test_batches_are_cut_by_tokens(spark, docs_of, monkeypatch):
    docs = docs_of([(i, "word " * i, "a") for i in range(40)]).drop("ids")
    tokenizer = bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    assert [*bpe._groups([3, 1, 1_000_000, 5, 1])] == [(0, 2), (2, 3), (3, 5)]
    batches = [pa.record_batch({"t": pa.array(["a" * n for n in part], pa.string())}) for part in ([3, 4, 0], [9, 1], [], [1])]
    monkeypatch.setattr(bpe, "CHARS_PER_REPLAY", 8)
    assert [[len(x.as_py()) for x in b.column("t")] for b in bpe._by_chars(iter(batches), "t")] == [[3, 4, 0], [9], [1, 1]]
    both = tokenizer.there_and_back(docs).select("doc_id", "ids", "decoded").collect()
    assert sorted(both) == sorted(tokenizer.decode(tokenizer.encode(docs)).select("doc_id", "ids", "decoded").collect())
    got = tokenizer.decode(tokenizer.encode(docs)).select("doc_id", "decoded").collect()
    assert {r[0]: bytes(r[1]) for r in got} == {i: b"word " * i for i in range(40)}
