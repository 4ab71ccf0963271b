"""Near-duplicates by MinHash bands, odd sketches and full sets of word shingles.

1. Every text becomes its set of word shingles: a digest of the set, MinHash
   samples folded into band keys, and an odd sketch (Mitzenmacher, Pagh and
   Pham 2014): the parity, per bit, of the samples that hash to it. Two
   sketches' exclusive or has a population count that tells their similarity
   closely where it is high. Texts of one digest are one node from here on.
2. Nodes that share a band key are a bucket. Each bucket names a few centres,
   the least of its nodes in several fixed orders; every node is paired with
   its buckets' centres. Pairs whose sketches are far apart go, the others are
   compared on their full sets, and links make components.
3. In a bucket of more nodes, two that aren't centres may be linked although no
   centre is linked with both. So where a bucket still has several components,
   all nodes outside its largest are compared with all its nodes, again on full sets.

No pairs are made within a bucket beyond those with its centres: the last step
compares blocks of bounded size inside tasks and returns links alone. A bucket or centre
with many nodes is cut into such blocks. Bands are chosen so that a pair at the
threshold shares none with a probability of 5e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import bounded_batches, fresh, written
from loomset.llm.components import components

BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
CENTRES = 3
#: Texts on either side of a comparison in one task.
LEFT_BLOCK, RIGHT_BLOCK = 500, 500

_WORDS_KEPT = 300_000
_CHUNK = 2048


class _Words(dict):
    """Hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@cache
def _constants() -> tuple[np.ndarray, ...]:
    draw = np.random.default_rng(20_240_607).integers(0, 2**64, (4, SAMPLES), np.uint64)
    return draw[0][:, None] | np.uint64(1), draw[1][:, None], draw[2] | np.uint64(1), draw[3]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int, words: _Words) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; the whole sequence is one if it is shorter."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    joined = np.full(n, width, np.uint64)
    for k in range(width):
        joined = _mixed(joined * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return np.unique(joined)


def samples(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of a set."""
    times, plus, _, _ = _constants()
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), _CHUNK):
        np.minimum(least, (shingles[None, lo : lo + _CHUNK] * times + plus).min(axis=1), out=least)
    return least


def odd_sketch(minima: np.ndarray) -> np.ndarray:
    """Parities of the samples by bit, as 64-bit words."""
    _, _, times, plus = _constants()
    bits = (_mixed(minima * times + plus) % np.uint64(SKETCH_BITS)).astype(np.int64)
    parity = (np.bincount(bits, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for column in minima.reshape(BANDS, ROWS).T:
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def similarity(differing: Column) -> Column:
    """The similarity that a number of differing sketch bits stands for; 0 where there are too many."""
    share = differing * (2.0 / SKETCH_BITS)
    return F.when(share < 1, F.greatest(F.lit(0.0), 1 + F.log(1 - share) * (SKETCH_BITS / (4.0 * SAMPLES)))).otherwise(0.0)


def differing_bits(a: str, b: str) -> Column:
    """Population count of two sketches' exclusive or."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``key``, ``print``, ``n_shingles``, ``digest``, ``sketch``, ``bands`` of (key, print, text) rows; no digest for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            sizes, digests, sketches, bands = [], [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), width, words)
                sizes.append(len(shingles))
                if len(shingles):
                    minima = samples(shingles)
                    digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    sketches.append(odd_sketch(minima))
                    bands.append(band_keys(minima))
                else:
                    for column in (digests, sketches, bands):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("print"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sketches, pa.list_(pa.int64())),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["key", "print", "n_shingles", "digest", "sketch", "bands"],
            )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"key {kind}, print string, n_shingles long, digest binary, sketch array<bigint>, bands array<bigint>"
    )


def _links_between(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Which sets of the left are as similar as asked to which of the right."""
    sizes = np.fromiter(map(len, right), np.int64, len(right))
    holder = np.repeat(np.arange(len(right)), sizes)
    shingles = np.concatenate(right)
    order = np.argsort(shingles, kind="stable")
    shingles, holder = shingles[order], holder[order]
    for i, own in enumerate(left):
        lo = np.searchsorted(shingles, own, "left")
        counts = np.searchsorted(shingles, own, "right") - lo
        at = np.repeat(lo - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        shared = np.bincount(holder[at], minlength=len(right))
        for j in np.flatnonzero(100 * shared >= percent * (len(own) + sizes - shared)).tolist():
            yield i, j


def _compared(blocks: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``a``, ``b`` found in blocks (``part``, ``cut``, ``left``: a boolean, ``node``, ``label``).

    Within a block nodes of one label aren't compared, and of several links
    between two labels one is enough.
    """

    def run(block: pa.Table) -> pa.Table:
        words = _Words()
        side = block.column("left").to_pylist()
        nodes, labels = block.column("node").to_pylist(), block.column("label").to_pylist()
        # One text at a time becomes a Python string.
        sets = [shingle_set(t.as_py(), width, words) for t in block.column("text")]
        left, right = ([i for i, s in enumerate(side) if s is flag] for flag in (True, False))
        found = []
        parent: dict[int, int] = {}

        def top(label: int) -> int:
            while parent.get(label, label) != label:
                label = parent[label]
            return label

        if left and right:
            for i, j in _links_between([sets[i] for i in left], [sets[j] for j in right], percent):
                i, j = left[i], right[j]
                x, y = top(labels[i]), top(labels[j])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((nodes[i], nodes[j]))
        return pa.table(
            {"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())}
        )

    return blocks.join(texts, "node").groupBy("part", "cut").applyInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` or more.

    Returns one row per input row: ``key``, ``n_shingles``, ``component_id`` (the
    smallest key reachable over links) and ``kept``: whether key = component_id and, of
    different texts with that key, the text is the one that stays. Words
    are runs of anything but ASCII white space, with A-Z lower-cased. Null
    texts, empty ones and ones of white space alone are linked with nothing.
    Equal texts are linked. Rows that repeat a key are in one component if their texts are; those that
    repeat key and text are kept or not alike. A row without a key takes part in no link; its
    component is null and it isn't kept.
    """
    return _told(docs, key, text, width, percent).select(F.col("key").alias(key), "n_shingles", "component_id", "kept")


def _print(text: str) -> Column:
    """What tells a text from others of the same key."""
    return F.md5(F.col(text))


def _told(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """``key``, ``print``, ``n_shingles``, ``component_id``, ``kept`` of each row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    signed = written(signatures(rows.withColumn("print", _print("text")), width), "near-signatures")
    nodes = written(
        signed.filter("digest IS NOT NULL AND key IS NOT NULL")
        .groupBy("digest")
        .agg(F.min(F.struct("key", "print", "sketch", "bands")).alias("least"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "least.*"),
        "near-nodes",
    )
    placed = nodes.select("node", F.explode("bands").alias("bucket"))
    orders = [F.col("node"), *(F.xxhash64("node", F.lit(n)) for n in range(1, CENTRES))]
    # Written before the join, so that Spark can split a bucket that many nodes share.
    buckets = written(
        placed.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.array(*[F.min_by("node", o) for o in orders]).alias("centres"),
        )
        .filter("size > 1"),
        "near-buckets",
    )
    members = written(placed.join(buckets, "bucket"), "near-members")

    # Pairs with centres; sketches first, then full sets.
    pairs = (
        members.select(F.explode(F.array_distinct("centres")).alias("part"), "node").filter("part != node").distinct()
    )
    sketches = nodes.select("node", "sketch")
    close = written(
        pairs.join(sketches.toDF("part", "part_sketch"), "part")
        .join(sketches, "node")
        .filter(similarity(differing_bits("part_sketch", "sketch")) >= percent / 100 - 0.3)
        .select("part", "node"),
        "near-pairs",
    )
    cuts = close.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / RIGHT_BLOCK).cast("int").alias("cuts"))
    label = F.col("node").alias("label")
    stars = (
        close.join(cuts, "part")
        .select("part", F.pmod(F.xxhash64("node"), "cuts").cast("int").alias("cut"), F.lit(False).alias("left"), "node", label)
        .union(
            cuts.select(
                "part",
                F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"),
                F.lit(True),
                F.col("part"),
                F.col("part"),
            )
        )
    )
    wanted = members.select("node").distinct().join(nodes.select("node", "key", "digest"), "node")
    texts = written(_texts(rows, wanted, width), "near-texts")
    links = written(_compared(stars, texts, width, percent), "near-links")
    labels = written(components(links), "near-labels")

    # Buckets that still hold several components, but for those all of whose pairs had a centre.
    told = members.filter(_has_untold_pairs()).join(labels, "node", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("label")
    )
    classes = told.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = written(
        classes.groupBy("bucket")
        .agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("size"))
        .filter("main.n < size")
        .select(
            "bucket",
            F.col("main.label").alias("main"),
            F.ceil(F.col("size") / RIGHT_BLOCK).cast("int").alias("rights"),
            F.ceil((F.col("size") - F.col("main.n")) / LEFT_BLOCK).cast("int").alias("lefts"),
        ),
        "near-mixed",
    )
    open_members = written(told.join(mixed, "bucket"), "near-open")
    if not open_members.isEmpty():
        turn = lambda n: F.pmod(F.xxhash64("node", "bucket"), n).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        rights = open_members.withColumn("other", every("lefts")).select(
            F.col("bucket").alias("part"),
            (F.col("other") * F.col("rights") + turn(F.col("rights"))).alias("cut"),
            F.lit(False).alias("left"),
            "node",
            "label",
        )
        lefts = open_members.filter("label != main").withColumn("other", every("rights")).select(
            F.col("bucket").alias("part"),
            (turn(F.col("lefts")) * F.col("rights") + F.col("other")).alias("cut"),
            F.lit(True).alias("left"),
            "node",
            "label",
        )
        more = written(_compared(lefts.union(rights), texts, width, percent), "near-links")
        if not more.isEmpty():
            labels = written(components(links.union(more)), "near-labels")

    rooted = nodes.join(labels, "node", "left").select("digest", "key", "print", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min(F.struct("key", "print")).alias("stays"))
    classes = rooted.join(least, "root").select("digest", "stays")
    with_key = F.col("key").isNotNull()
    return (
        signed.select("key", "print", "n_shingles", "digest")
        .join(classes, "digest", "left")
        .select(
            "key",
            "print",
            "n_shingles",
            F.when(with_key, F.coalesce("stays.key", "key")).alias("component_id"),
            (with_key & F.coalesce((F.col("stays.key") == F.col("key")) & (F.col("stays.print") == F.col("print")), F.lit(True))).alias("kept"),
        )
    )


def _has_untold_pairs() -> Column:
    """Whether a bucket has two nodes that aren't centres; the orders may name one node several times."""
    return F.col("size") > F.array_size(F.array_distinct("centres")) + 1


def _texts(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node``, ``text``: the text of each wanted node (``node``, ``key``, ``digest``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            # A key that several rows have brings other texts along; only the node's own may stay.
            own = [
                hashlib.blake2b(shingle_set(t.as_py(), width, words).tobytes(), digest_size=16).digest() == d.as_py()
                for t, d in zip(batch.column("text"), batch.column("digest"))
            ]
            yield batch.select(["node", "text"]).filter(pa.array(own, pa.bool_()))

    found = rows.join(wanted, "key").select("node", "text", "digest").mapInArrow(run, "node long, text string")
    return found


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without those of which a near-duplicate stays; columns unchanged.

    The text with the smallest key stays, and other texts of a key that repeats go or stay by themselves.
    Rows that repeat key and text go or stay alike. Rows without a key stay, as they are linked with nothing.
    """
    own, print_ = fresh(docs, "key"), fresh(docs, "print")
    options = {"width": 5, "percent": 80} | options
    gone = _told(docs, key, text, **options).filter(~F.col("kept") & F.col("key").isNotNull())
    gone = gone.select(F.col("key").alias(own), F.col("print").alias(print_)).distinct()
    return docs.join(gone, (F.col(key) == F.col(own)) & (_print(text) == F.col(print_)), "left_anti")
