"""Importance resampling of documents towards the words of a target set.

Features are runs of words, hashed into a fixed number of buckets by the CRC of
their UTF-8 bytes. A bucket's gain is how much likelier the target is to show it
than the documents are; a document's weight is its features' mean gain. With a
Gumbel noise added that the key fixes, the documents of highest score are a
draw without replacement in proportion to the exponentials of the weights.

The CRCs of a batch are computed as matrices: features of equal length are one
matrix of bytes, reduced to its distinct rows, and all its CRCs are carried
forward together, a column at a time. What they come to is dealt back to the
places of the features.

Bucket counts are summed up by each task before they are shuffled, and buckets
are all that the driver sees. Scores are whole numbers of a bounded range, so
counts of them say exactly which are drawn and where each one's ranks begin.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.llm.common import pieces_of, small_batches, written

BUCKETS = 10_000
#: Bytes of text whose features are hashed together, but for a longer text.
BYTES_PER_PIECE = 4 << 20
#: Longer features have their CRC taken one by one: a matrix of a single row gains nothing.
LONGEST_IN_MATRIX = 256
#: Copies of one document that one task numbers at a time.
COPIES_PER_CHUNK = 100_000

#: For each byte, what it stands for in a word: itself, a lower-case letter, or 0 for none.
_IN_WORD = np.zeros(256, np.uint8)
_IN_WORD[0x80:] = np.arange(0x80, 0x100)
for _first, _last, _becomes in (("0", "9", "0"), ("a", "z", "a"), ("A", "Z", "a")):
    _IN_WORD[ord(_first) : ord(_last) + 1] = np.arange(ord(_last) - ord(_first) + 1) + ord(_becomes)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


class Words:
    """The words of some texts: one stream of their bytes with a space after each, and where each begins."""

    def __init__(self, texts: pa.Array):
        nothing, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        ended = pc.binary_join_element_wise(pc.fill_null(texts, "").cast(pa.large_string()), nothing, space)
        bounds = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset : ended.offset + len(ended) + 1]
        raw = np.frombuffer(ended.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        code = _IN_WORD[raw]
        inside = code != 0
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.concatenate(([0], edges))
        ends = edges[1::2]
        self.lengths = ends - edges[0::2]
        #: Number of the first word of each text, and of all words.
        self.first = np.searchsorted(ends, bounds - bounds[0], "right") if len(ends) else np.zeros(len(bounds), np.int64)
        inside[ends] = True
        self.stream = np.where(code == 0, np.uint8(0x20), code)[inside]
        self.starts = np.cumsum(self.lengths + 1) - (self.lengths + 1)

    def runs(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of so many words: where they start in the stream, their lengths, and for each text where its runs start and all end."""
        held = np.maximum(np.diff(self.first) - (order - 1), 0)
        cuts = np.concatenate(([0], np.cumsum(held)))
        at = np.arange(cuts[-1]) + np.repeat(self.first[:-1] - cuts[:-1], held)
        last = at + order - 1
        starts = self.starts[at]
        return starts, self.starts[last] + self.lengths[last] - starts, cuts


def crcs(stream: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of each of these stretches of a stream of bytes."""
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(np.minimum(lengths, LONGEST_IN_MATRIX + 1).astype(np.uint16), kind="stable")
    sorted_lengths = lengths[order]
    cuts = np.flatnonzero(np.diff(np.minimum(sorted_lengths, LONGEST_IN_MATRIX + 1))) + 1
    for group in np.split(order, cuts) if len(order) else []:
        length = int(lengths[group[0]])
        if length > LONGEST_IN_MATRIX:
            for i in group:
                out[i] = zlib.crc32(stream[starts[i] : starts[i] + lengths[i]])
            continue
        at = starts[group]
        matrix = np.empty((length, len(group)), np.uint8)
        for column in range(length):
            matrix[column] = stream[at + column]
        which, distinct = _distinct(matrix)
        crc = np.full(distinct.shape[1], 0xFFFFFFFF, np.uint32)
        for column in distinct:
            crc = _CRC[(crc ^ column) & 0xFF] ^ crc >> 8
        out[group] = (crc ^ np.uint32(0xFFFFFFFF))[which]
    return out


def _distinct(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the stretches that are the columns of a matrix, its number among the distinct ones; and those."""
    which = np.zeros(matrix.shape[1], np.int64)
    for low in range(0, len(matrix), 8):
        part = np.zeros(matrix.shape[1], np.uint64)
        for shift, row in enumerate(matrix[low : low + 8]):
            part |= row.astype(np.uint64) << np.uint64(8 * shift)
        codes, values = pd.factorize(part)
        which = pd.factorize(which * len(values) + codes)[0] if low else codes
    first = np.empty(which.max(initial=-1) + 1, np.int64)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    return which, matrix[:, first]


def feature_counts(df: DataFrame, text: str = "text", orders: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; a null text has none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for low, high in pieces_of(texts, BYTES_PER_PIECE):
                words = Words(texts[low:high])
                for order in range(1, orders + 1):
                    starts, lengths, _ = words.runs(order)
                    total += np.bincount(crcs(words.stream, starts, lengths) % buckets, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    counted = df.select(F.col(text)).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    with small_batches(df.sparkSession):
        for r in counted.collect():
            out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the logarithm of how much likelier each bucket is in the target, add-one smoothed, floored."""
    s, t = source.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(s)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def importance(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text", orders: int = 1) -> DataFrame:
    """Per document ``key``, ``n_words``, ``n_features`` and ``weight``, the floored mean gain (0 without features)."""
    buckets = len(gains)
    schema = T.StructType(
        [T.StructField("key", docs.schema[key].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")]
    )

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for low, high in pieces_of(texts, BYTES_PER_PIECE):
                words = Words(texts[low:high])
                held, total = np.zeros(high - low, np.int64), np.zeros(high - low, np.int64)
                for order in range(1, orders + 1):
                    starts, lengths, cuts = words.runs(order)
                    so_far = np.concatenate(([0], np.cumsum(gains[crcs(words.stream, starts, lengths) % buckets])))
                    held += np.diff(cuts)
                    total += np.diff(so_far[cuts])
                columns = [np.diff(words.first), held, total // np.maximum(held, 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], *[pa.array(c, pa.int64()) for c in columns]], schema.names
                )

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(weigh, schema)


def gumbel_noise(key: Column, seed: int) -> Column:
    """Thousand times a Gumbel variate, floored, from the first 32 bits of a hash of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((head + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    orders: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """Every document's ``key``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the documents with at least ``min_words`` words, ``percent`` hundredths
    (floored) are drawn, highest scores first, ties to the smaller key; ``rank``
    counts them from 1 and is null for the others.

    Null and empty texts have no features, weight 0, and are never drawn unless
    ``min_words`` is 0. A null key comes last among ties. Rows that repeat a key
    share their noise and are drawn one by one, in no order if they are equal. Empty
    tables are fine on either side; other columns don't matter, whatever their names.
    """
    gains = bucket_gains(feature_counts(docs, text, orders, buckets), feature_counts(target, target_text, orders, buckets))
    weighed = importance(docs, gains, key, text, orders)
    with small_batches(docs.sparkSession):
        scored = written(weighed.withColumn("score", F.col("weight") + gumbel_noise(F.col("key"), seed)), "resample-scores")

    # One row per score: at most some 200,000, as weights are logarithms of counts and the noise has 32 bits.
    higher = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    eligible = F.col("n_words") >= min_words
    scores = written(
        scored.filter(eligible)
        .groupBy("score")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "score",
            F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("above"),
            F.call_function("div", F.sum("n").over(Window.partitionBy()) * percent, F.lit(100).cast("long")).alias("drawn"),
        )
        .filter("above < drawn"),
        "resample-cut",
    )
    lowest, drawn = scores.agg(F.min("score"), F.max("drawn")).first()
    named = [F.col("key").alias(key), "n_features", "weight", "score"]
    if lowest is None:
        return scored.select(*named, F.lit(None).cast("long").alias("rank"))

    # Equal rows are one until their ranks are dealt out.
    at_score = Window.partitionBy("score").orderBy(F.col("key").asc_nulls_last(), "n_features", "weight")
    groups = (
        scored.filter(eligible & (F.col("score") >= lowest))
        .groupBy("key", "n_features", "weight", "score")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(F.broadcast(scores), "score")
        .withColumn("after", F.col("above") + F.sum("n").over(at_score.rowsBetween(Window.unboundedPreceding, 0)))
    )
    chunk = F.lit(COPIES_PER_CHUNK).cast("long")
    ranked = (
        groups.withColumn("low", F.explode(F.sequence(F.col("after") - F.col("n") + 1, F.col("after"), chunk)))
        .repartition("low")
        .withColumn("rank", F.explode(F.sequence("low", F.least("after", F.col("low") + chunk - 1))))
        .select(*named, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    )
    rest = scored.filter(~(eligible & (F.col("score") >= lowest))).select(*named, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


def draw(docs: DataFrame, target: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The drawn documents, all columns unchanged, in no order; rows that share a drawn key are all kept."""
    ranks = resample(docs, target, key, **options).filter("rank is not null").select(F.col(key).alias("drawn_key")).distinct()
    left, right = docs.alias("d"), ranks.alias("r")
    return left.join(right, F.col(f"d.`{key}`").eqNullSafe(F.col("r.drawn_key")), "left_semi")
