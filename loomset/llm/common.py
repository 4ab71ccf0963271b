"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from loomset.session import scratch_dir

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read back.

    Cuts the lineage: later steps read files that outlive any executor.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until the table has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches have this many rows, unless the session asks for a number of its own.

    Spark's 10,000 whole documents in a batch are several copies of tens of MB
    in every task, in the executor and in Python.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, rows)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most this many rows for the jobs run inside; afterwards the session's setting holds again."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pieces_of(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes, but for a longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(texts):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + size, "right")))
        yield low, high
        low = high
