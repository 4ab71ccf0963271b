"""The n-th smallest of the rows' places, found by counting ranges rather than by sorting.

Every round cuts the range that holds the wanted place at some of its own
values, picked by hash, counts the rows between them, and goes on in the one
part that the running sum of the counts points to. Counts are summed up by each
task, so a round moves a few thousand small rows however large the table is, and
the driver sees one row per part. A round leaves about one part in ``BRANCHES``;
once a part has few rows, or equal ones only, the place is there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts a round cuts a range into, about.
BRANCHES = 64
#: Rows that one task sorts at the end, whatever n is.
FEW = 4096


def nth_smallest(df: DataFrame, n: int, columns: list[Column], few: int = FEW) -> Column | None:
    """``nth_place`` as a constant to compare structs of the columns with."""
    place = nth_place(df, n, columns, few)
    return None if place is None else _constant(place, df.select(F.struct(*columns).alias("at")).schema["at"].dataType)


def nth_place(df: DataFrame, n: int, columns: list[Column], few: int = FEW) -> Row | None:
    """The n-th smallest (from 1) of structs of these named columns, or ``None`` if there are fewer rows.

    Nulls are smallest. Rows that are equal count one by one. The rows are read
    once for every round, about log(rows / few) / log(``BRANCHES``) times and two more,
    by these columns alone; filters on the first of them reach the scan.
    """
    shape = df.select(F.struct(*columns).alias("at")).schema["at"].dataType
    if n <= few:
        return _last_of_first(df.select(F.struct(*columns).alias("at")), n)
    low = high = None
    splitters: list[Row] = []
    for seed in range(10_000):
        at = F.col("at")
        inside = _first_column_between(df, columns[0], low, high).select(F.struct(*columns).alias("at"))
        if low is not None:
            inside = inside.filter(at >= _constant(low, shape))
        if high is not None:
            inside = inside.filter(at < _constant(high, shape))
        parts = _parts(inside, splitters, shape, seed)
        before = 0
        for part in parts:
            if before + part["held"] >= n:
                break
            before += part["held"]
        else:
            return None
        if part["same"]:
            return part["splitters"][0]
        i = part["part"]
        low = splitters[i - 1] if i > 0 else low
        high = splitters[i] if i < len(splitters) else high
        n -= before
        if part["held"] <= few:
            end = _first_column_between(df, columns[0], low, high).select(F.struct(*columns).alias("at"))
            bounds = [b for b in (low is not None and at >= _constant(low, shape), high is not None and at < _constant(high, shape)) if b is not False]
            return _last_of_first(reduce(DataFrame.filter, bounds, end), n)
        splitters = part["splitters"]
    raise RuntimeError("the rows change while they are counted")


def _parts(inside: DataFrame, splitters: list[Row], shape: T.StructType, seed: int) -> list[Row]:
    """Per part between the splitters, in order: its rows, whether all are equal, and splitters of its own.

    A part's greatest value is among its splitters: it is cut off from lesser
    ones, so that each round leaves less than the one before.
    """
    at = F.col("at")
    hashed = F.xxhash64("at", F.lit(seed))
    return (
        inside.select("at", _part_of(at, splitters, shape).alias("part"), hashed.alias("hash"))
        .groupBy("part", F.pmod("hash", F.lit(BRANCHES)).alias("bucket"))
        .agg(
            F.count(F.lit(1)).alias("held"),
            F.max_by("at", "hash").alias("probe"),
            F.min("at").alias("least"),
            F.max("at").alias("greatest"),
        )
        .groupBy("part")
        .agg(
            F.sum("held").alias("held"),
            F.min("least").eqNullSafe(F.max("greatest")).alias("same"),
            F.array_sort(F.array_distinct(F.concat(F.collect_list("probe"), F.array(F.max("greatest"))))).alias("splitters"),
        )
        .orderBy("part")
        .collect()
    )


def _part_of(at: Column, splitters: list[Row], shape: T.StructType) -> Column:
    """How many splitters are not above a value, by halving: six or seven comparisons."""

    def search(first: int, last: int) -> Column:
        if first == last:
            return F.lit(first)
        middle = (first + last) // 2
        return F.when(at < _constant(splitters[middle], shape), search(first, middle)).otherwise(search(middle + 1, last))

    return search(0, len(splitters))


def _first_column_between(df: DataFrame, first: Column, low: Row | None, high: Row | None) -> DataFrame:
    """Bounds on the first column alone: in this form a scan can skip what lies outside."""
    if low is not None and low[0] is not None:
        df = df.filter(first >= F.lit(low[0]))
    if high is not None and high[0] is not None:
        df = df.filter(first.isNull() | (first <= F.lit(high[0])))
    return df


def _last_of_first(places: DataFrame, n: int) -> Row | None:
    """The n-th of few: each task keeps its n smallest, one finishes."""
    end = places.orderBy("at").limit(n).agg(F.max("at").alias("last"), F.count(F.lit(1)).alias("held")).first()
    return end["last"] if end["held"] == n else None


def _constant(row: Row, shape: T.StructType) -> Column:
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in shape.fields])
