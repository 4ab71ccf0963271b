"""Byte-level BPE, encoded by replaying the merges over all words of a batch at once.

The words of a batch of texts are its matches of the splitting pattern. Each
distinct word is laid out once, as a chain of byte tokens. An inverted index
leads from a merge's rank to the positions where its pair of tokens stands. The
merges are replayed in rank order: a merge is applied at all its positions
together, and only the pairs on either side of a merged one are looked up and
indexed anew. The texts then take their words' tokens.

Nothing is shuffled and a batch is a bounded share of one partition, so memory
does not grow with the corpus. Ranks reach the executors as a broadcast of
fixed size (the vocabulary); the rank file only has to be readable on the driver.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.llm.common import bounded_batches

#: Tokens in an output batch, but for a longer text.
TOKENS_PER_BATCH = 500_000
#: Characters of the texts whose words are replayed together, but for a longer text.
CHARS_PER_REPLAY = 8_000_000

_NONE = np.iinfo(np.int32).max
_SHIFT = 24


class Lists:
    """Many short arrays, end to end."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        self.values, self.lengths = values, lengths
        self.starts = np.cumsum(lengths) - lengths

    def take(self, which: np.ndarray) -> np.ndarray:
        """The arrays with these numbers, end to end."""
        lengths = self.lengths[which]
        shift = self.starts[which] - (np.cumsum(lengths) - lengths)
        return self.values[np.repeat(shift, lengths) + np.arange(lengths.sum())]


class Merges:
    """A rank table: which two tokens join, and into which."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        names = [b""] * size
        for name, rank in ranks.items():
            names[rank] = name
        self.names = Lists(
            np.frombuffer(b"".join(names), np.uint8), np.fromiter(map(len, names), np.int64, size)
        )
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[name[:k]], ranks[name[k:]], rank)
            for name, rank in ranks.items()
            for k in range(1, len(name))
            if name[:k] in ranks and name[k:] in ranks
        ]
        left, right, joined = np.array(pairs, np.int64).reshape(-1, 3).T
        keys = left << _SHIFT | right
        order = np.argsort(keys)
        self.keys, self.joined = keys[order], joined[order].astype(np.int32)
        #: Tokens that can join at once into one of lower rank; their merges go one at a time in a word.
        self.hasty = np.zeros(size, bool)
        self.hasty[left[joined < left]] = True
        self.hasty[right[joined < right]] = True
        self.of_bytes = self.look_up(np.repeat(self.of_byte, 256), np.tile(self.of_byte, 256)).reshape(256, 256)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each joined pair, or _NONE."""
        if not len(self.keys):
            return np.full(len(left), _NONE, np.int32)
        wanted = left.astype(np.int64) << _SHIFT | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.joined[at], _NONE)

    def replay(self, words: list[bytes]) -> Lists:
        """The tokens of each of these non-empty words."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        n = len(data)
        token = self.of_byte[data]
        after = np.arange(1, n + 1, dtype=np.int64)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int64)
        before[starts] = -1
        alive = np.ones(n, bool)
        rank = np.full(n, _NONE, np.int32)
        if n > 1:
            rank[:-1] = self.of_bytes[data[:-1], data[1:]]
        rank[ends - 1] = _NONE

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(ranks)]
            for r, lo, hi in zip(ranks[bounds[:-1]].tolist(), bounds, bounds[1:]):
                if r in index:
                    index[r].append(at[lo:hi])
                else:
                    index[r] = [at[lo:hi]]
                    heapq.heappush(heap, r)

        first = np.flatnonzero(rank != _NONE)
        if len(first):
            add(first, rank[first])
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            at = parts[0] if len(parts) == 1 else np.sort(np.concatenate(parts))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if len(at) > 1:
                if self.hasty[r]:
                    _, lead = np.unique(np.searchsorted(ends, at, "right"), return_index=True)
                    if len(lead) < len(at):
                        later = np.ones(len(at), bool)
                        later[lead] = False
                        index[r] = [at[later]]
                        heapq.heappush(heap, r)
                        at = at[lead]
                else:
                    at = _every_other(at, after)
            right = after[at]
            beyond = after[right]
            token[at] = r
            alive[right] = False
            rank[right] = _NONE
            rank[at] = _NONE
            after[at] = beyond
            more = beyond >= 0
            before[beyond[more]] = at[more]
            ahead = before[at]
            touched = np.concatenate((at[more], ahead[ahead >= 0]))
            if not len(touched):
                continue
            if len(touched) > 1:
                touched = np.unique(touched)
            new = self.look_up(token[touched], token[after[touched]])
            rank[touched] = new
            joins = new != _NONE
            if joins.any():
                add(touched[joins], new[joins])
        return Lists(token[alive], np.add.reduceat(alive, starts, dtype=np.int64) if n else lengths)

    def encode(self, words: list[str]) -> Lists:
        """Tokens of words; a word that is itself a token is that token."""
        raw = [w.encode() for w in words]
        whole = np.fromiter((self.ranks.get(w, -1) for w in raw), np.int64, len(raw))
        rest = np.flatnonzero(whole < 0)
        if not len(rest):
            return Lists(whole.astype(np.int32), np.ones(len(raw), np.int64))
        split = self.replay([raw[i] for i in rest.tolist()])
        lengths = np.ones(len(raw), np.int64)
        lengths[rest] = split.lengths
        out = Lists(np.empty(lengths.sum(), np.int32), lengths)
        out.values[out.starts[whole >= 0]] = whole[whole >= 0]
        inside = np.repeat(whole < 0, lengths)
        out.values[inside] = split.values
        return out


def _every_other(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions whose pairs overlap in a row, the first, third and so on."""
    linked = after[at[:-1]] == at[1:]
    if not linked.any():
        return at
    here = np.arange(len(at))
    start = np.where(np.concatenate(([True], ~linked)), here, 0)
    return at[(here - np.maximum.accumulate(start)) % 2 == 0]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file of lines ``base64 rank``, on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Tokenizer:
    """Encodes and decodes columns by the ranks of a file and a splitting pattern."""

    def __init__(self, spark, path: str, pattern: str):
        bounded_batches(spark)
        self.pattern = pattern
        self.merges = spark.sparkContext.broadcast(Merges(read_ranks(path)))

    def encode(self, docs: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        """The rows, with ``text`` replaced by ``ids`` (array<int>); a null text has no tokens.

        Each match of the pattern is encoded on its own, without special
        tokens. A table without rows gives none.
        """
        merges, pattern = self.merges, self.pattern

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _encoded(batches, merges.value, pattern, text, ids)

        return docs.mapInArrow(run, self._with_ids(docs, text, ids))

    def _with_ids(self, docs: DataFrame, text: str, ids: str) -> T.StructType:
        fields = [f for f in docs.schema.fields if f.name != text]
        return T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def decode(self, tokens: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        """The rows, with the bytes of their tokens as ``decoded``; null ids decode to no bytes."""
        merges = self.merges

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _decoded(batches, merges.value, ids, decoded)

        return tokens.mapInArrow(run, self._with_bytes(tokens.schema, decoded))

    def _with_bytes(self, schema: T.StructType, decoded: str) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField(decoded, T.BinaryType(), False)])

    def there_and_back(
        self, docs: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded"
    ) -> DataFrame:
        """``decode(encode(docs))``, in one pass through Python."""
        merges, pattern = self.merges, self.pattern

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _decoded(_encoded(batches, merges.value, pattern, text, ids), merges.value, ids, decoded)

        return docs.mapInArrow(run, self._with_bytes(self._with_ids(docs, text, ids), decoded))


def _encoded(
    batches: Iterator[pa.RecordBatch], merges: Merges, pattern: str, text: str, ids: str
) -> Iterator[pa.RecordBatch]:
    find = regex.compile(pattern).findall
    for batch in _by_chars(batches, text):
        numbers: defaultdict[str, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        number = numbers.__getitem__
        used = []
        for value in batch.column(text):
            words = find(value.as_py() or "")
            used.append(np.fromiter(map(number, words), np.int32, len(words)))
            del words
        vocabulary = merges.encode(list(numbers))
        del numbers, number
        rest = batch.drop_columns([text])
        counts = np.array([vocabulary.lengths[u].sum() for u in used], np.int64)
        for lo, hi in _groups(counts.tolist()):
            some = counts[lo:hi]
            values = vocabulary.take(np.concatenate(used[lo:hi])) if some.sum() else np.empty(0, np.int32)
            yield _with(rest.slice(lo, hi - lo), ids, _list_array(some, values))


def _decoded(
    batches: Iterator[pa.RecordBatch], merges: Merges, ids: str, decoded: str
) -> Iterator[pa.RecordBatch]:
    names = merges.names
    for batch in batches:
        lists = batch.column(ids)
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(counts)
        for lo, hi in _groups(counts.tolist()):
            begin = ends[lo] - counts[lo]
            part = flat[begin : ends[hi - 1]]
            sizes = np.zeros(hi - lo, np.int64)
            full = np.flatnonzero(counts[lo:hi])
            if len(full):
                sizes[full] = np.add.reduceat(names.lengths[part], (ends[lo:hi] - counts[lo:hi])[full] - begin)
            text = names.take(part) if len(part) else np.empty(0, np.uint8)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
            array = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), hi - lo, [None, pa.py_buffer(offsets), pa.py_buffer(text)]
            )
            yield _with(batch.slice(lo, hi - lo), decoded, array.cast(pa.binary()))


def _by_chars(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about CHARS_PER_REPLAY characters of text."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_pylist()
        lo = 0
        for i, n in enumerate(lengths):
            if size and size + n > CHARS_PER_REPLAY:
                held.append(batch.slice(lo, i - lo))
                yield _joined(held)
                held, size, lo = [], 0, i
            size += n
        held.append(batch.slice(lo))
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0] if sum(map(len, batches)) else batches[0]


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows that together have about TOKENS_PER_BATCH tokens."""
    lo, total = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > TOKENS_PER_BATCH:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def _list_array(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def id_text(ids: str):
    """Decimal ids joined by commas."""
    return F.concat_ws(",", F.col(ids).cast("array<string>"))
