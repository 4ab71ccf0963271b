"""Apply a row format, built in or supplied by the user."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loomset.functions import formats
from loomset.functions.text import fresh, ref

FORMATS: dict[str, Callable[..., Column]] = {
    "alpaca": formats.alpaca,
    "sharegpt": formats.sharegpt,
    "chatml": formats.chatml,
    "llama": formats.llama,
    "custom": formats.custom,
}

# These always print headings or markers, so their text is never blank.
NEVER_BLANK = frozenset({"alpaca", "chatml", "llama", "custom"})

def render(df: DataFrame, format: str | Callable[..., Column], **options) -> DataFrame:
    """Add (or overwrite) ``text``; all other columns stay.

    ``format`` is a built-in name or any function from the DataFrame to a
    Column.
    """
    if not callable(format) and format not in FORMATS:
        raise ValueError(f"format must be one of {sorted(FORMATS)}, got {format!r}")
    text = (format if callable(format) else FORMATS[format])(df, **options)
    return with_text(df, text)


def with_text(df: DataFrame, text: Column) -> DataFrame:
    """Set ``text`` and nothing else: a column ``Text`` is another column."""
    columns = [text.alias("text") if c == "text" else ref(c) for c in df.columns]
    return df.select(*columns, *([] if "text" in df.columns else [text.alias("text")]))


def map_rows(
    df: DataFrame,
    fn: Callable[[dict[str, Any]], Mapping[str, Any]],
    returns: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Merge what a Python row function returns into each row.

    For formatters that cannot be written as a Column. ``columns`` names what
    the function looks at; only that travels to Python, in Arrow batches. The
    parallelism is the input's, without a shuffle; ``partitions`` spreads an
    input of few parts over more tasks first. ``returns`` gives a Spark type,
    as in DDL, for each column: ``string``, ``array<string>``,
    ``struct<a: int>`` and so on.
    """
    returns = dict(returns or {"text": "string"})
    result_type = T.StructType([T.StructField(name, _type_of(t)) for name, t in returns.items()])
    arrow_type = to_arrow_type(result_type)

    def apply(rows: pa.Array) -> pa.Array:
        return pa.array([dict(fn(row)) for row in rows.to_pylist()], type=arrow_type)

    spread = df.repartition(partitions) if partitions else df
    name = fresh(df, "made")
    made = spread.select("*", F.arrow_udf(apply, result_type)(_row(df, columns)).alias(name))
    kept = [ref(c) for c in df.columns if c not in returns]
    return made.select(*kept, *[F.col(name).getField(field).alias(field) for field in returns])


def _type_of(ddl: str) -> T.DataType:
    try:
        return T.StructType.fromDDL(f"value {ddl}").fields[0].dataType
    except ParseException as error:
        raise ValueError(f"not a type: {ddl!r}") from error


def filter_rows(
    df: DataFrame,
    predicate: Callable[[dict[str, Any]], bool] | Column,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Keep rows by a Column, or by a Python function of (the named columns of) the row."""
    if isinstance(predicate, Column):
        return df.filter(predicate)

    def apply(rows: pa.Array) -> pa.Array:
        return pa.array([bool(predicate(row)) for row in rows.to_pylist()], type=pa.bool_())

    return df.filter(F.arrow_udf(apply, T.BooleanType())(_row(df, columns)))


def _row(df: DataFrame, columns: Sequence[str] | None) -> Column:
    return F.struct(*[ref(c) for c in columns or df.columns])
