"""Places of rows in the files they come from, and ranges of rows by position.

Rows stand in the order of their files' paths, and within a file in its own
order. Only counts per file and row numbers are looked at, never rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.operators.selection import nth_place

_FILE, _ROW = "_metadata.file_path", "_metadata.row_index"


def has_field(df: DataFrame, field: str) -> bool:
    try:
        df.select(field)
    except AnalysisException:
        return False
    return True


def knows_files(df: DataFrame) -> bool:
    return has_field(df, _FILE)


def numbers_rows(df: DataFrame) -> bool:
    """Whether the source gives each row its index within the file, as Parquet does."""
    return has_field(df, _ROW)


def file_of_nth(df: DataFrame, n: int) -> tuple[str, int] | None:
    """The file of the n-th row (from 1), and which of the file's rows it is; ``None`` if there are fewer.

    For unfiltered Parquet only footers are read. The running sum is over one
    row per file, a list the driver holds anyway to plan the scan.
    """
    held = df.groupBy(F.col(_FILE).alias("path")).agg(F.count(F.lit(1)).alias("held"))
    so_far = F.sum("held").over(
        Window.orderBy("path").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    hit = held.withColumn("so_far", so_far).filter(F.col("so_far") >= n).orderBy("path").first()
    if hit is None:
        return None
    return hit["path"], n - (hit["so_far"] - hit["held"])


def place_of_nth(df: DataFrame, n: int) -> tuple[str, int] | None:
    """File and row index of the n-th row (from 1) of a DataFrame that numbers its rows.

    Filters of the DataFrame count: the row index is that of the n-th row they leave.
    """
    found = file_of_nth(df, n)
    if found is None:
        return None
    path, nth = found
    return path, nth_place(df.filter(F.col(_FILE) == path), nth, [F.col(_ROW).alias("row")])["row"]


def up_to(place: tuple[str, int]) -> Column:
    """Whether a row stands no later than a place."""
    path, index = place
    at_path = F.col(_FILE)
    return (at_path < path) | ((at_path == path) & (F.col(_ROW) <= index))


def rows_between(df: DataFrame, start: int, stop: int | None) -> DataFrame:
    """Rows of positions ``start`` (from 0) up to, not including, ``stop``; rows stay where they are."""
    if stop is not None and stop <= start:
        return df.limit(0)
    chosen = df
    if start > 0:
        before = place_of_nth(df, start)
        if before is None:
            return df.limit(0)
        chosen = chosen.filter(~up_to(before))
    last = None if stop is None else place_of_nth(df, stop)
    return chosen if last is None else chosen.filter(up_to(last))
