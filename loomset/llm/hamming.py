"""Exact top-k search of binary codes by Hamming distance, over several indexes of code segments.

A code is cut into m segments, each with an inverted index of its values. If
two codes differ in at most m * (r + 1) - 1 bits, some segment of theirs differs in at
most r. So with growing radius r every segment is probed at all values exactly r
bits away; what is met for the first time is verified on the whole code. A
query ends once the distance of its k-th code is within what radius r covers;
only the others go on. (Norouzi, Punjani and Fleet 2014.)

Equal codes are indexed and searched once, however many rows have them. Only
the k smallest keys of a code can be among the k nearest, and only those are kept.

Codes are dealt by hash into shards of bounded size. A task holds the indexes of
one shard and takes queries in batches; the probes of a ring are made there, a
bounded number at a time, and never stored, sent or broadcast. What a shard
returns of a query are its k nearest that no earlier radius met, none of them
farther than the k-th that all shards have found so far. That distance also tells
how many of the segments the last radius of a query has to probe.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.llm.common import written

#: Segments are at most this wide, so that rings of probes stay small.
WIDEST = 16
#: Codes whose indexes a task holds, and queries that meet them there.
_CODES, _QUERIES = 1 << 20, 1 << 18
#: Probes and codes that are looked at together; their numbers stay in a core's cache.
_AT_ONCE = 1 << 17


def sign_code(vector: str, bits: int = 64) -> Column:
    """A long whose i-th bit tells whether the vector's i-th number is positive; null for a null vector.

    Missing and null numbers count as not positive.
    """
    marks = F.transform(
        F.slice(F.col(vector), 1, bits),
        lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")),
    )
    return F.aggregate(marks, F.lit(0).cast("long"), lambda code, bit: code.bitwiseOR(bit))


def _segments(bits: int, codes: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment; about log2(codes) wide."""
    width = min(WIDEST, max(2, round(math.log2(max(codes, 2)))))
    count = math.ceil(bits / width)
    cuts = [bits * i // count for i in range(count + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


class _Index:
    """The codes of a shard, sorted by the values of each segment."""

    def __init__(self, codes: np.ndarray, segments: list[tuple[int, int]]):
        self.segments = segments
        #: For each segment where each value begins, and the places and codes in this order.
        self.lists = []
        for segment in segments:
            values = _values(codes, segment)
            begins = np.zeros((1 << segment[1]) + 1, np.int64)
            np.cumsum(np.bincount(values, minlength=1 << segment[1]), out=begins[1:])
            order = np.argsort(values.astype(np.uint16), kind="stable").astype(np.int32)
            self.lists.append((begins, order, codes[order]))

    def search(
        self, asked: np.ndarray, bound: np.ndarray, radius: int, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of queries, places of codes and distances: the k nearest of each query that this radius meets first.

        Codes farther than a query's bound are left out. Order is by distance, then place.
        """
        met = _Nearest(bound, k)
        before = len(self.segments) * radius - 1
        for i, segment in enumerate(self.segments):
            ring = _ring(segment[1], radius)
            # Each segment covers one bit more than all have before.
            open_ = np.flatnonzero(met.bound - before > i)
            step = max(1, _AT_ONCE // max(1, len(ring)))
            for low in range(0, len(open_) if len(ring) else 0, step):
                some = open_[low : low + step]
                probes = (_values(asked[some], segment)[:, None] ^ ring).ravel()
                self._verify(i, radius, np.repeat(some, len(ring)), probes, asked, met)
        return met.ended()

    def _verify(
        self, i: int, radius: int, who: np.ndarray, probes: np.ndarray, asked: np.ndarray, met: _Nearest
    ) -> None:
        """Compare queries with all codes that have the probed values in segment i."""
        begins, order, codes = self.lists[i]
        first = begins[probes]
        sizes = begins[probes + 1] - first
        hit = np.flatnonzero(sizes)
        who, first, sizes = who[hit], first[hit], sizes[hit]
        ends = np.cumsum(sizes)
        low, done = 0, 0
        while low < len(who):
            high = max(low + 1, int(np.searchsorted(ends, done + _AT_ONCE, "right")))
            n, whose, until = sizes[low:high], who[low:high], ends[low:high] - done
            spots = np.repeat(first[low:high] - (until - n), n)
            spots += np.arange(len(spots))
            differs = codes[spots]
            differs ^= np.repeat(asked[whose], n)
            distance = np.bitwise_count(differs)
            near = np.flatnonzero(distance <= met.bound[whose].max())
            if len(near):
                whose, differs, distance = whose[np.searchsorted(until, near, "right")], differs[near], distance[near]
                # A code is met in the first of the segments that are nearest, and nowhere else.
                fits = distance <= met.bound[whose]
                for j, segment in enumerate(self.segments):
                    fits &= np.bitwise_count(_values(differs, segment)) >= (radius + 1 if j < i else radius)
                met.add(whose[fits], order[spots[near[fits]]], distance[fits])
            low, done = high, int(ends[high - 1])


class _Nearest:
    """The k nearest of each query among what was added; bounds shrink to the k-th distance."""

    def __init__(self, bound: np.ndarray, k: int):
        self.bound, self.k = bound.astype(np.int64), k
        self.parts: list[np.ndarray] = []
        self.size, self.most = 0, _AT_ONCE

    def add(self, who: np.ndarray, place: np.ndarray, distance: np.ndarray) -> None:
        # One number that sorts by query, distance (at most 64) and place (an int).
        self.parts.append((who << 40) | (distance.astype(np.int64) << 32) | place)
        self.size += len(who)
        if self.size > self.most:
            self._shrink()
            self.most = self.size + _AT_ONCE

    def _shrink(self) -> None:
        packed = np.sort(np.concatenate([np.zeros(0, np.int64), *self.parts]))
        who = packed >> 40
        begins = np.flatnonzero(np.diff(who, prepend=-1))
        nth = np.arange(len(who)) - np.repeat(begins, np.diff(begins, append=len(who)))
        last = packed[nth == self.k - 1]
        self.bound[last >> 40] = np.minimum(self.bound[last >> 40], (last >> 32) & 255)
        self.parts = [packed[nth < self.k]]
        self.size = len(self.parts[0])

    def ended(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._shrink()
        (packed,) = self.parts
        return packed >> 40, packed & (2**32 - 1), (packed >> 32) & 255


def _values(codes: np.ndarray, segment: tuple[int, int]) -> np.ndarray:
    lo, width = segment
    return ((codes >> np.uint64(lo)) & np.uint64((1 << width) - 1)).astype(np.int64)


@cache
def _ring(width: int, radius: int) -> np.ndarray:
    """All values of a width with that many bits set."""
    return np.flatnonzero(np.bitwise_count(np.arange(1 << width)) == radius)


def _met(
    index: DataFrame, active: DataFrame, segments: list[tuple[int, int]], radius: int, k: int, shards: int, blocks: int
) -> DataFrame:
    """``asked``, ``code``, ``least``, ``distance``: of each shard the k nearest that this radius meets first.

    ``index`` has ``code`` and ``least``, ``active`` has ``asked`` and ``bound``. Each block of
    queries meets each shard in a task of its own.
    """
    all_ = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    none = lambda kind: F.lit(None).cast(kind)
    least = index.schema["least"].dataType
    held = index.select(
        all_(blocks).alias("block"),
        dealt("code", shards).alias("shard"),
        none("long").alias("asked"),
        none("int").alias("bound"),
        "code",
        "least",
    )
    asking = active.select(
        dealt("asked", blocks).alias("block"),
        all_(shards).alias("shard"),
        "asked",
        "bound",
        none("long").alias("code"),
        none(least).alias("least"),
    )
    cell = (F.col("block") * shards + F.col("shard")).alias("cell")
    cells = held.union(asking).select(cell, "asked", "bound", "code", "least")
    # Nulls come first: a cell's codes, least keys first, and then its queries.
    cells = cells.repartitionById(blocks * shards, F.col("cell")).sortWithinPartitions("cell", "asked", "least")
    at_once = max(1, _AT_ONCE // k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, found, parts = None, None, []
        for batch in batches:
            at_row = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(at_row)) + 1).tolist(), len(at_row)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo < hi and at_row[lo] != at:
                    at, found, parts = at_row[lo], None, []
                codes = batch.column(1).slice(lo, hi - lo).null_count
                if codes:
                    parts.append(batch.slice(lo, codes).select([3, 4]))
                if codes < hi - lo and parts:
                    own, keys = (c.combine_chunks() for c in pa.Table.from_batches(parts).columns)
                    own, parts = own.to_numpy().view(np.uint64), []
                    found = _Index(own, segments)
                if found is None:
                    continue
                for low in range(lo + codes, hi, at_once):
                    some = batch.slice(low, min(at_once, hi - low))
                    asked, bound = some.column(1).to_numpy().view(np.uint64), some.column(2).to_numpy()
                    order = np.argsort(bound, kind="stable")
                    asked = asked[order]
                    who, place, distance = found.search(asked, bound[order], radius, k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(asked[who].view(np.int64)),
                            pa.array(own[place].view(np.int64)),
                            keys.take(pa.array(place)),
                            pa.array(distance, pa.int32()),
                        ],
                        schema.names,
                    )

    schema = T.StructType(
        [
            T.StructField("asked", T.LongType()),
            T.StructField("code", T.LongType()),
            T.StructField("least", least),
            T.StructField("distance", T.IntegerType()),
        ]
    )
    return cells.mapInArrow(run, schema)


def top_k(
    rows: DataFrame, queries: DataFrame, k: int = 10, bits: int = 64, key: str = "key", code: str = "code"
) -> DataFrame:
    """The k rows nearest to each query: ``query``, ``rank`` (from 1), ``key``, ``distance``.

    Both tables have a key and a code of ``bits`` (at most 64) bits in a long. Order is by
    distance, then key. Fewer than k rows come back only if there are fewer;
    null keys and codes neither ask nor answer. Rows that repeat a key count
    each; so do repeated queries.
    """
    by_key = Window.partitionBy("code").orderBy("key")
    kept = written(
        rows.select(F.col(key).alias("key"), F.col(code).cast("long").alias("code"))
        .dropna()
        .withColumn("nth", F.row_number().over(by_key))
        .filter(F.col("nth") <= k),
        "hamming-rows",
    )
    asked = written(
        queries.select(F.col(key).alias("query"), F.col(code).cast("long").alias("asked")).dropna(), "hamming-queries"
    )
    index = kept.filter("nth = 1").select("code", F.col("key").alias("least"))
    codes = index.count()
    segments = _segments(bits, codes)
    # No two codes are farther apart than the bits of a long.
    active = written(asked.select("asked").distinct().withColumn("bound", F.lit(64)), "hamming-active")
    ended, going = [], None
    by_distance = Window.partitionBy("asked").orderBy("distance", "least")
    of_query = Window.partitionBy("asked")
    for radius in range(max(width for _, width in segments) + 1):
        shards, blocks = max(1, math.ceil(codes / _CODES)), max(1, math.ceil(active.count() / _QUERIES))
        met = _met(index, active, segments, radius, k, shards, blocks)
        covered = len(segments) * (radius + 1) - 1
        covered = 64 if covered >= bits else covered
        found = written(
            (met if going is None else going.union(met))
            .withColumn("nth", F.row_number().over(by_distance))
            .filter(F.col("nth") <= k)
            .withColumn("n", F.count(F.lit(1)).over(of_query))
            .withColumn("farthest", F.when(F.col("n") < k, 64).otherwise(F.max("distance").over(of_query))),
            "hamming-found",
        )
        ended.append(found.filter(F.col("farthest") <= covered).select("asked", "code", "distance"))
        going = found.filter(F.col("farthest") > covered).select(met.columns)
        bounds = found.filter("nth = 1").select("asked", "farthest")
        active = written(
            active.join(bounds, "asked", "left")
            .select("asked", F.coalesce("farthest", F.lit(64)).alias("bound"))
            .filter(F.col("bound") > covered),
            "hamming-active",
        )
        if active.isEmpty():
            break
    nearest = Window.partitionBy("asked").orderBy("distance", "key")
    answers = (
        reduce(DataFrame.union, ended)
        .join(kept, "code")
        .withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("asked", "rank", "key", "distance")
    )
    return asked.join(answers, "asked").select("query", "rank", "key", "distance")
