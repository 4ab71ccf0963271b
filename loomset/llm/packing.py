"""Packing of documents into sequences of equal length, as a cutting-stock problem.

Documents become token ids. What is longer than a sequence is cut into whole
sequences and a rest. The rests are counted by length, in steps of ``unit``
tokens, and this histogram is all that the driver sees. It says how many items
of each length are to be cut from how few sequences: a linear program over
patterns (how many items of each length share one sequence), solved by column
generation. The program starts with one pattern per length; a knapsack over the
lengths, priced by the program's duals, finds the pattern that would save most,
until none saves anything worth while. The times each pattern is used are
rounded down, and what is then left over is packed first fit, longest first.

Rests of one length are ranked, by slices of equal size. A rest's rank says
which use of which pattern takes it.

So far nothing but long documents is cut, and a few tokens in each sequence
stay free. The emptiest sequences are therefore dissolved, as many as can go, and
their documents are laid end to end along the free places of all others. Every
sequence is then full, but for a last stretch shorter than one; that makes
sequences whose lengths are the powers of two in it, which need no padding either.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.llm.bpe import Lists
from loomset.llm.common import pieces_of, small_batches, written

#: Bytes of the texts that are encoded together, but for a longer text.
BYTES_PER_PIECE = 8_000_000
#: Words that a Python worker remembers with their ids, and how many new ones are encoded together.
WORDS_KNOWN, WORDS_AT_ONCE = 2_000_000, 1000
#: Sequences, or tokens along the free places as so many sequences, that one window takes.
_BLOCK = 4096
_CELL = 64

class _Encoder:
    """Ids of texts, by the words between ASCII white space; each word is encoded once and remembered."""

    def __init__(self, rules: str, width: int, end: int):
        # A task has one core; the library would start as many threads as the machine has.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(rules)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Texts can't forge special tokens.
        self.tokenizer.encode_special_tokens = True
        self.width, self.end = width, end
        #: Whether it lower-cases anyway: then words that differ in that are one.
        self.lower = '"type":"Lowercase"' in rules.replace(" ", "")
        self.forget()

    def forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids = Lists(np.zeros(0, f"<u{self.width}"), np.zeros(0, np.int64))

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of each text, then the end, as binary."""
        if len(self.words) > WORDS_KNOWN:
            self.forget()
        texts = pc.fill_null(texts, "")
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if self.lower else texts)
        words = split.flatten().dictionary_encode()
        number = pc.index_in(words.dictionary, value_set=self.words)
        unknown = words.dictionary.filter(pc.is_null(number))
        number = pc.fill_null(number, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        number[number < 0] = np.arange(len(self.words), len(self.words) + len(unknown))
        self._learn(unknown)
        codes = number[words.indices.to_numpy(zero_copy_only=False)]
        held = np.concatenate(([0], np.cumsum(self.ids.lengths[codes])))
        bounds = held[split.offsets.to_numpy() - split.offsets[0].as_py()]
        ids = np.insert(self.ids.take(codes), bounds[1:], self.end)
        ends = (bounds + np.arange(len(bounds))) * self.width
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])

    def _learn(self, unknown: pa.Array) -> None:
        """Encodes words side by side; where a token begins tells whose it is."""
        values, lengths = [self.ids.values], [self.ids.lengths]
        words = [w.decode("utf-8", "replace") for w in unknown.cast(pa.binary()).to_pylist()]
        for low in range(0, len(words), WORDS_AT_ONCE):
            part = words[low : low + WORDS_AT_ONCE]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            starts = np.cumsum([0] + [len(w) + 1 for w in part[:-1]])
            begins = np.fromiter(map(itemgetter(0), found.offsets), np.int64)
            lengths.append(np.bincount(np.searchsorted(starts, begins, "right") - 1, minlength=len(part)))
            values.append(np.array(found.ids, f"<u{self.width}"))
        self.words = pa.concat_arrays([self.words, unknown])
        self.ids = Lists(np.concatenate(values), np.concatenate(lengths))


@lru_cache(maxsize=1)
def _encoder(rules: str, width: int, end: int) -> _Encoder:
    """One to a Python worker, whatever tasks it is given."""
    return _Encoder(rules, width, end)


def encode(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer_file: str,
    end: int,
    key: str = "doc_id",
    text: str = "text",
    width: int = 2,
) -> DataFrame:
    """A written table of ``row``, ``key``, ``ids`` and ``n_tokens``: each text's ids without special tokens, then ``end``.

    For tokenizers that drop white space and never join over it. The file is
    read on the driver and broadcast. ``ids`` is binary, little-endian numbers
    of ``width`` bytes, 2 or 4. A null text is empty and has the end alone; rows
    are told apart by ``row``, so keys may repeat or be null.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        rules = spark.sparkContext.broadcast(f.read())
    from tokenizers import Tokenizer

    largest = max(end, *Tokenizer.from_str(rules.value).get_vocab(with_added_tokens=True).values())
    if largest >> 8 * width:
        raise ValueError(f"ids up to {largest} don't fit into {width} bytes")
    schema = T.StructType(
        [T.StructField("key", docs.schema[key].dataType), T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(rules.value, width, end)
        for batch in batches:
            for low, high in pieces_of(batch.column(1), BYTES_PER_PIECE):
                ids = encoder.encode(batch.column(1)[low:high])
                lengths = pc.divide(pc.binary_length(ids).cast(pa.int64()), width)
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], ids, lengths], schema.names)

    encoded = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)
    with small_batches(spark, 3000):
        return written(encoded.select(F.monotonically_increasing_id().alias("row"), *schema.names), "packing-tokens")


def ids_crc32(ids: str, width: int = 2) -> Column:
    """The CRC-32 of ids as little-endian numbers of four bytes."""

    def crc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            wide = (np.frombuffer(b, f"<u{width}").astype("<u4") for b in batch.to_pylist())
            yield pa.array([zlib.crc32(w) for w in wide], pa.int64())

    return F.arrow_udf(crc, T.LongType())(ids)


def _best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of lengths 1, 2, ... within a capacity that is worth most, by dynamic programming."""
    lengths = np.flatnonzero(values > 0) + 1
    worth = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    gains = values[lengths - 1]
    for room in range(1, capacity + 1):
        fitting = int(np.searchsorted(lengths, room, "right"))
        worth[room], last[room] = worth[room - 1], 0
        if fitting:
            total = worth[room - lengths[:fitting]] + gains[:fitting]
            best = int(total.argmax())
            if total[best] > worth[room]:
                worth[room], last[room] = total[best], lengths[best]
    pattern, room = np.zeros(len(values)), capacity
    while room:
        if last[room]:
            pattern[last[room] - 1] += 1
        room -= int(last[room]) or 1
    return float(worth[capacity]), pattern


def patterns(demand: np.ndarray, capacity: int, gap: float = 0.0005, most_rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns, one per column, and how often each is used, so that every length gets exactly what is demanded.

    ``demand`` counts items of length 1, 2, ... up to the capacity. Columns are
    generated until the program is within ``gap`` of its least number of
    sequences (or for ``most_rounds``; what is found by then is a packing all
    the same). Fuller patterns come first.
    """
    wanted = np.flatnonzero(demand)
    whole = np.zeros((len(demand), 0), np.int64)
    if not len(wanted):
        return whole, np.zeros(0, np.int64)
    need = demand[wanted].astype(float)
    basis = np.diag((capacity // (wanted + 1)).astype(float))
    inverse, used = np.diag(1 / np.diag(basis)), need / np.diag(basis)
    # Small products, so without the threads of a linear algebra library, which the launch of a JVM may have left stuck.
    product, matrix_product = partial(np.einsum, "ij,j->i"), partial(np.einsum, "ij,jk->ik")
    for round_ in range(most_rounds):
        duals = inverse.sum(axis=0)
        values = np.zeros(len(demand))
        values[wanted] = duals
        value, pattern = _best_pattern(values, capacity)
        # No packing takes fewer than a value-th of what the program takes now.
        if value <= 1 + 1e-9 or used.sum() * (1 - 1 / value) < max(gap * used.sum(), 0.5):
            break
        column = pattern[wanted]
        enters = product(inverse, column)
        ratios = np.full(len(used), np.inf)
        np.divide(used, enters, out=ratios, where=enters > 1e-9)
        leaves = int(ratios.argmin())
        if not np.isfinite(ratios[leaves]):
            break
        basis[:, leaves] = column
        step = ratios[leaves]
        used = np.maximum(used - step * enters, 0)
        used[leaves] = step
        row = inverse[leaves] / enters[leaves]
        inverse -= np.outer(enters, row)
        inverse[leaves] = row
        if round_ % 100 == 99:  # what rounding has added up to, taken out by a step of Newton's
            inverse = 2 * inverse - matrix_product(inverse, matrix_product(basis, inverse))
            used = np.maximum(product(inverse, need), 0)

    times = np.floor(used + 1e-9).astype(np.int64)
    columns = basis.round().astype(np.int64)
    left = demand[wanted] - columns @ times
    while (left < 0).any():  # by the rounding of large numbers
        over = int(left.argmin())
        drop = int(np.flatnonzero((columns[over] > 0) & (times > 0))[0])
        times[drop] -= 1
        left += columns[:, drop]
    extra, extra_times = [], []
    while left.any():
        pattern, room = np.zeros(len(wanted), np.int64), capacity
        for i in range(len(wanted) - 1, -1, -1):
            pattern[i] = min(left[i], room // (wanted[i] + 1))
            room -= pattern[i] * (wanted[i] + 1)
        held = pattern > 0
        again = int((left[held] // pattern[held]).min())
        extra.append(pattern)
        extra_times.append(again)
        left = left - again * pattern
    columns = np.column_stack([columns, *extra])
    times = np.concatenate([times, np.array(extra_times, np.int64)])
    columns, times = columns[:, times > 0], times[times > 0]
    order = np.argsort(-(wanted + 1) @ columns, kind="stable")
    whole = np.zeros((len(demand), len(order)), np.int64)
    whole[wanted] = columns[:, order]
    return whole, times[order]


def _slots(columns: np.ndarray, times: np.ndarray) -> list[tuple]:
    """Per length with any items: which ranks go to which pattern, how many to each use, and the first use's number."""
    first = np.cumsum(times) - times
    out = []
    for i in np.flatnonzero(columns.any(axis=1)):
        at = np.flatnonzero(columns[i])
        ends = np.cumsum(columns[i, at] * times[at])
        starts = ends - columns[i, at] * times[at]
        out.append((int(i) + 1, [tuple(map(int, s)) for s in zip(starts, ends, columns[i, at], first[at])]))
    return out


def _sum_before(amount: str, window) -> Column:
    """The sum of an amount over the rows before this one."""
    return F.coalesce(F.sum(amount).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _with_starts(df: DataFrame, amount: str, block: Column, *order: Column | str) -> DataFrame:
    """``start``: the sum of an amount over all earlier rows, in two levels; one row per block passes through one task."""
    blocked = df.withColumn("block", block)
    blocks = blocked.groupBy("block").agg(F.sum(amount).alias("held"))
    blocks = blocks.select("block", _sum_before("held", Window.orderBy("block")).alias("blocks_before"))
    inside = _sum_before(amount, Window.partitionBy("block").orderBy(*order))
    summed = blocked.withColumn("start", inside).join(blocks, "block")
    return summed.withColumn("start", F.col("blocks_before") + F.col("start")).drop("block", "blocks_before")


_PIECE = "struct<start: bigint, length: bigint, sequence_id: bigint, offset: bigint>"


def _piece(start, length, sequence_id, offset) -> Column:
    named = [F.lit(v) if isinstance(v, int) else v for v in (start, length, sequence_id, offset)]
    return F.struct(*named).cast(_PIECE)


def pack(tokens: DataFrame, capacity: int = 4096, unit: int = 16, width: int = 2, rows_per_slice: int = 20_000) -> DataFrame:
    """Pieces of documents in sequences: ``key``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``tokens`` is a table of ``encode``. ``start`` counts the document's ids
    before the piece, ``offset`` those before it in the sequence. Every id is in
    one piece. Sequences are numbered from 0 and hold ``capacity`` ids, but for
    the last few rests, which have a power of two each. ``unit`` must divide
    ``capacity``; a larger one makes the program smaller and more documents cut.

    Documents of any length are fine, as are repeated or null keys. An empty table has no pieces.
    """
    if capacity % unit:
        raise ValueError(f"{unit} does not divide {capacity}")
    spark = tokens.sparkSession
    rest = F.col("n_tokens") % capacity
    lengths = tokens.select(
        "row",
        F.call_function("div", "n_tokens", F.lit(capacity).cast("long")).alias("full"),
        rest.alias("rest"),
        F.ceil(rest / unit).cast("int").alias("bin"),
    )
    bins = lengths.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("rest").alias("tokens"), F.sum("full").alias("full")).collect()
    demand = np.zeros(capacity // unit, np.int64)
    for r in bins:
        if r["bin"]:
            demand[r["bin"] - 1] = r["n"]
    columns, times = patterns(demand, capacity // unit)
    kept, left = divmod(sum(r["tokens"] for r in bins), capacity)
    tails = [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
    first_full = kept + len(tails)

    # Ranks of the rests of one length, and of the whole sequences that documents start with, over slices.
    slices = max(1, math.ceil(sum(r["n"] for r in bins) / rows_per_slice))
    sliced = lengths.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices)))
    offsets = sliced.groupBy("slice", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("full_of_bin"))
    offsets = offsets.withColumn("ranks_before", _sum_before("n", Window.partitionBy("bin").orderBy("slice")))
    fulls = offsets.groupBy("slice").agg(F.sum("full_of_bin").alias("n"))
    fulls = fulls.select("slice", _sum_before("n", Window.orderBy("slice")).alias("fulls_before"))
    within = Window.partitionBy("slice", "bin").orderBy("row")
    ranked = (
        sliced.repartition("slice")
        .withColumn("rank", F.row_number().over(within) - 1)
        .withColumn("fulls", _sum_before("full", Window.partitionBy("slice").orderBy("row")))
        .join(offsets.select("slice", "bin", "ranks_before"), ["slice", "bin"])
        .join(fulls, "slice")
        .withColumn("rank", F.col("rank") + F.col("ranks_before"))
        .withColumn("first_full", F.col("fulls") + F.col("fulls_before") + first_full)
    )
    # At most one row per length.
    slots = spark.createDataFrame(_slots(columns, times), "bin int, slots array<struct<low: bigint, high: bigint, each: bigint, first: bigint>>")
    slot = F.filter("slots", lambda s: (F.col("rank") >= s["low"]) & (F.col("rank") < s["high"]))[0]
    placed = written(
        ranked.join(F.broadcast(slots), "bin", "left")
        .withColumn("slot", slot)
        .withColumn(
            "sequence_id",
            F.col("slot.first") + F.call_function("div", F.col("rank") - F.col("slot.low"), F.col("slot.each")),
        )
        .select("row", "full", "rest", "bin", "rank", "first_full", "sequence_id"),
        "packing-places",
    )

    # Those that stay, one after the other; the others along the free places behind them.
    in_sequence = Window.partitionBy("sequence_id").orderBy(F.col("bin").desc(), "rank")
    rests = placed.filter(F.col("rest") > 0)
    staying = rests.filter(F.col("sequence_id") < kept)
    settled = staying.withColumn("offset", _sum_before("rest", in_sequence))
    free = staying.groupBy("sequence_id").agg(F.sum("rest").alias("offset")).withColumn("free", capacity - F.col("offset"))
    block = F.call_function("div", F.col("sequence_id"), F.lit(_BLOCK).cast("long"))
    free = written(_with_starts(free.filter("free > 0"), "free", block, "sequence_id"), "packing-free")
    end = free.agg(F.max(F.col("start") + F.col("free"))).first()[0] or 0
    ends = np.cumsum([0, *tails])
    more = [(kept + i, 0, int(size), int(end + at)) for i, (size, at) in enumerate(zip(tails, ends))]
    free = free.unionByName(spark.createDataFrame(more, "sequence_id long, offset long, free long, start long"))
    loose = _with_starts(rests.filter(F.col("sequence_id") >= kept), "rest", block, "sequence_id", F.col("bin").desc(), "rank")

    # Both lie along one axis. Their bounds cut it into the pieces, cell by cell.
    cell_size = _CELL * capacity
    everything = int(end) + left

    def by_cell(df: DataFrame, length: str, **columns: Column) -> DataFrame:
        cell = lambda at: F.call_function("div", at, F.lit(cell_size).cast("long"))
        cells = F.sequence(cell(F.col("start")), cell(F.col("start") + F.col(length) - 1))
        cut = df.withColumn("cell", F.explode(cells)).withColumn("at", F.greatest("start", F.col("cell") * cell_size))
        return cut.select("cell", "at", *[c.alias(n) for n, c in columns.items()])

    none = F.lit(None)
    bounds = by_cell(
        free, "free", place=F.struct("sequence_id", (F.col("offset") - F.col("start")).alias("shift")), of=none.cast("struct<row: bigint, shift: bigint>")
    ).unionByName(
        by_cell(
            loose,
            "rest",
            place=none.cast("struct<sequence_id: bigint, shift: bigint>"),
            of=F.struct("row", (F.col("full") * capacity - F.col("start")).alias("shift")),
        )
    )
    along = Window.partitionBy("cell").orderBy("at", F.col("place").isNull())
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    cell_end = F.least((F.col("cell") + 1) * cell_size, F.lit(everything))
    filled = (
        bounds.withColumn("end", F.coalesce(F.lead("at").over(along), cell_end))
        .withColumns({"place": F.last("place", True).over(so_far), "of": F.last("of", True).over(so_far)})
        .filter("at < end")
        .select(
            F.col("of.row").alias("row"),
            _piece(F.col("of.shift") + F.col("at"), F.col("end") - F.col("at"), F.col("place.sequence_id"), F.col("place.shift") + F.col("at")).alias("piece"),
        )
    )

    # All pieces of a document, then its ids to each.
    whole = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("full") - 1),
        lambda i: _piece(i * capacity, capacity, F.col("first_full") + i, 0),
    )
    nothing = F.array().cast(f"array<{_PIECE}>")
    by_row = (
        placed.filter(F.col("full") > 0).select("row", whole.alias("pieces"))
        .unionByName(settled.select("row", F.array(_piece(F.col("full") * capacity, F.col("rest"), F.col("sequence_id"), F.col("offset"))).alias("pieces")))
        .unionByName(filled.select("row", F.array("piece").alias("pieces")))
        .groupBy("row")
        .agg(F.flatten(F.collect_list("pieces")).alias("pieces"))
    )
    joined = tokens.join(by_row, "row")
    with_ids = F.transform(
        F.coalesce("pieces", nothing),
        lambda p: F.struct(
            p["start"].alias("start"),
            p["length"].alias("length"),
            F.substring(F.col("ids"), (p["start"] * width + 1).cast("int"), (p["length"] * width).cast("int")).alias("ids"),
            p["sequence_id"].alias("sequence_id"),
            p["offset"].alias("offset"),
        ),
    )
    return joined.select("key", F.col("n_tokens").alias("doc_tokens"), F.explode(with_ids).alias("p")).select(
        "key", "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset"
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``length`` and ``ids``, the pieces one after the other."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda so_far, p: F.concat(so_far, p["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
