"""Empty-text filter, counts, leading rows and preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.functions.text import fresh, has_text, ref
from loomset.operators.selection import nth_smallest
from loomset.session import scratch_dir
from loomset.sources import positions, readers

PREVIEW_CHARS = 500


def drop_empty(df: DataFrame, column: str = "text") -> DataFrame:
    return df.filter(has_text(ref(column)))


def require_rows(df: DataFrame) -> DataFrame:
    """Raise when nothing is left; stops at the first row found."""
    if df.isEmpty():
        raise ValueError("every rendered text is empty; do the columns fit the format?")
    return df


def filter_report(df: DataFrame, column: str = "text") -> DataFrame:
    """Rows before and after the empty-text filter, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(has_text(ref(column))).alias("rows_after"),
    )


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("num_rows"))


def first_n(df: DataFrame, n: int | None, key: str | Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows; ``None`` or 0 means all.

    With a key the order is the key's; of rows that share the last key taken
    those of earlier files and rows come first, and where rows have no such
    place such a tie is an error. Without a key the order is that of the source
    files: by path, then by row within the file. That needs a DataFrame read
    from files of one kind; filters on it count. Rows stay where they are: the
    n-th place is found by counting ranges of places (``selection``), so no task
    holds more than a few thousand of them, however large ``n`` is.
    """
    if not n:
        return df
    if n < 0:
        raise ValueError(f"n must not be negative, got {n}")
    if key is not None:
        return _up_to_nth_key(df, n, [key] if isinstance(key, str) else list(key))
    if not positions.knows_files(df):
        raise ValueError("these rows are not straight from files of one kind: name a key, or read them with places")
    if positions.numbers_rows(df):
        place = positions.place_of_nth(df, n)
        return df if place is None else df.filter(positions.up_to(place))
    found = positions.file_of_nth(df, n)
    if found is None:
        return df
    path, nth = found
    at_path = F.col("_metadata.file_path")
    names = tuple(fresh(df, name) for name in ("file", "part", "nth"))
    last_file = readers.placed(df.filter(at_path == path), names)
    return df.filter(at_path < path).union(first_n_placed(last_file, nth, names))


def first_n_placed(df: DataFrame, n: int, places: tuple[str, str, str]) -> DataFrame:
    """The first ``n`` rows by file, part of the file, and place in the part; those columns are dropped.

    ``places`` are columns of ``readers.placed``. A row's place in its part only
    holds while one plan runs, so rows are written with theirs to the shared scratch folder, and the n-th is found there.
    """
    path = scratch_dir(df.sparkSession, "first-n-rows")
    df.write.parquet(path)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    last = nth_smallest(saved, n, [ref(name).alias(name) for name in places])
    kept = saved
    if last is not None:
        kept = saved.filter(F.struct(*[ref(name).alias(name) for name in places]) <= last)
    return kept.drop(*places)


def _up_to_nth_key(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """Rows up to the n-th smallest key, and place for equal ones; rows stay where they are."""
    columns = [ref(k).alias(f"k{i}") for i, k in enumerate(keys)]
    if positions.numbers_rows(df):
        columns += [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    last = nth_smallest(df, n, columns)
    if last is None:
        return df
    first_key = last.getField("k0")
    # The first key alone too: in this form the scan can skip row groups.
    kept = df.filter(ref(keys[0]).isNull() | (ref(keys[0]) <= first_key)).filter(F.struct(*columns) <= last)
    if not positions.numbers_rows(df) and kept.count() > n:
        raise ValueError(f"rows share the last key of the first {n}; name a unique key")
    return kept


def preview(df: DataFrame, key: str | Sequence[str] | None = None, column: str = "text") -> DataFrame:
    """The first row's text, shortened for a log line."""
    return first_n(df, 1, key).select(F.substring(ref(column), 1, PREVIEW_CHARS).alias("preview"))
