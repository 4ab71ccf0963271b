"""The training load: detect the text, cap, order, and export by rank."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.operators import detect, lengths, order
from loomset.sources import positions, readers, shards

# What one task orders at most: rows, and bytes as the files hold them, which grow several times in memory.
ROWS_PER_SLICE = 250_000
BYTES_PER_SLICE = 64 << 20

# Names given to a file's path and a row's index in it.
SOURCE_KEY = ("source_file", "source_row")


def training_rows(
    spark: SparkSession,
    source: str,
    path: str,
    split: str = readers.DEFAULT_SPLIT,
    revision: str | None = None,
    text_field: str | None = None,
    key: str | Sequence[str] | None = None,
    seed: int = 42,
    max_seq_length: int | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    bytes_per_slice: int = BYTES_PER_SLICE,
    reading: readers.Reading = readers.Reading(),
) -> DataFrame:
    """Key, ``text`` and seeded ``position`` of every row (and its tokens, if capped).

    Without a key, rows are known by file and row index, which Parquet gives; the
    order is then fixed for that copy of the data. With a key it is fixed for
    the rows wherever they lie. The rows are counted first (from footers, for
    Parquet) so that the number of slices they are ordered in grows with them,
    and with the bytes of their files.
    """
    df = readers.read_source(spark, source, path, split, revision, reading)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    slices = max(1, math.ceil(df.count() / rows_per_slice), math.ceil(size / bytes_per_slice))
    if key is None:
        if not positions.numbers_rows(df):
            raise ValueError("this source does not number its rows: name a unique key, or save it first")
        keys = SOURCE_KEY
        at = (F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        df = df.select("*", *[value.alias(name) for name, value in zip(keys, at)])
    else:
        keys = (key,) if isinstance(key, str) else tuple(key)
    texts = detect.training_projection(df, text_field, keep=keys)
    rows = order.seeded_order(texts, keys, seed, slices, unique=keys == SOURCE_KEY)
    # After the shuffle, which then moves no tokens.
    return rows if max_seq_length is None else lengths.token_cap(rows, max_seq_length)


def export_for_ranks(
    spark: SparkSession,
    source: str,
    path: str,
    output: str,
    world_size: int,
    rows_per_file: int = 100_000,
    **options,
) -> None:
    """Write the training rows as one directory per rank, files in position order, and an index of them to resume by.

    Each slice gives every rank one file, so slices are as large as fills those
    files, within the bytes that one task orders. ``options`` are those of
    ``training_rows``.
    """
    rows_per_slice = max(rows_per_file * world_size, ROWS_PER_SLICE)
    rows = training_rows(spark, source, path, rows_per_slice=rows_per_slice, **options)
    order.export_shards(rows, output, world_size, rows_per_file=rows_per_file)
    shards.save_index(spark, output)
