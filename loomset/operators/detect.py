"""What the training loader decides from a table's column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomset.functions.text import ref
from loomset.operators.render import render


def is_alpaca(df: DataFrame) -> bool:
    return {"instruction", "output"} <= set(df.columns)


def autodetect(df: DataFrame, nulls: str = "empty") -> DataFrame:
    """Alpaca-shaped tables get the loader's text, over any text they carry."""
    if not is_alpaca(df):
        return df
    return render(df, "alpaca", variant="loader", nulls=nulls)


def resolve_text_field(df: DataFrame, configured: str | None = None, first_string: bool = False) -> str:
    """Name of the column to train on.

    ``text`` wins over the configured name; with neither, the first column of
    any type, or with ``first_string`` the first one that holds strings.
    """
    if is_alpaca(df) or "text" in df.columns:
        return "text"
    if configured is not None:
        return configured
    if first_string:
        for field in df.schema.fields:
            if isinstance(field.dataType, T.StringType):
                return field.name
        raise ValueError(f"no string column among {df.columns}")
    return df.columns[0]


def training_projection(
    df: DataFrame, configured: str | None = None, keep: tuple[str, ...] = (), nulls: str = "empty"
) -> DataFrame:
    """Only the text (and named key columns), so only those are read."""
    field = resolve_text_field(df, configured)
    ready = autodetect(df, nulls)
    return ready.select(*[ref(k) for k in keep], ref(field).alias("text"))
