"""Prepare a dataset: read, take the leading rows, render, filter, save, record."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomset.functions.text import fresh
from loomset.operators import quality
from loomset.operators.render import NEVER_BLANK, map_rows, render
from loomset.sources import positions, published, readers, sinks


@dataclass(frozen=True)
class PreparationReport:
    rows_before: int
    rows_after: int
    columns: tuple[str, ...]
    sample: str | None


def prepared_rows(
    raw: DataFrame,
    format: str | Callable[..., Column],
    keep_empty: bool = False,
    row_function: Callable[[dict[str, Any]], Mapping[str, Any]] | None = None,
    row_columns: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Rendered rows without the empty ones, lazily; batch or stream.

    Formats that always print headings cannot give an empty text, so they are
    not tested for it.
    """
    if row_function is not None:
        rendered = map_rows(raw, row_function, columns=row_columns)
    else:
        rendered = render(raw, format, **options)
    if keep_empty or (row_function is None and format in NEVER_BLANK):
        return rendered
    return quality.drop_empty(rendered)


def prepare(
    spark: SparkSession,
    input: str,
    output: str,
    format: str | Callable[..., Column],
    max_samples: int | None = None,
    key: str | Sequence[str] | None = None,
    keep_empty: bool = False,
    row_function: Callable[[dict[str, Any]], Mapping[str, Any]] | None = None,
    row_columns: Sequence[str] | None = None,
    reading: readers.Reading = readers.Reading(),
    publish: bool = False,
    **options,
) -> PreparationReport:
    """Run the whole preparation and leave a saved dataset with its manifest.

    The leading rows are those of the source's order, or of ``key``'s.
    ``reading`` says how JSON and CSV files are read. ``row_function`` renders with Python (given ``row_columns``, or all)
    instead of ``format``, which then is only the name recorded. With ``publish`` the output is a
    published dataset: a job that fails leaves its former version, and the manifest is the commit's note.
    """
    raw = readers.read_raw(spark, input, reading)
    if max_samples and key is None and not positions.knows_files(raw):
        # JSON lines and arrays together: each row is read with its place.
        places = tuple(fresh(raw, name) for name in ("file", "part", "nth"))
        raw = quality.first_n_placed(readers.read_raw(spark, input, reading, places), max_samples, places)
    else:
        raw = quality.first_n(raw, max_samples, key)
    arguments = dict(keep_empty=keep_empty, row_function=row_function, row_columns=row_columns, **options)
    if not keep_empty:
        quality.require_rows(prepared_rows(raw, format, **arguments))

    read = Observation("rows_read")
    counted = raw.observe(read, F.count(F.lit(1)).alias("rows"))
    kept = prepared_rows(counted, format, **arguments)
    name = format if isinstance(format, str) else getattr(format, "__name__", "custom")
    if publish:
        commit = published.publish(kept, output, note={"source": input, "format": name})
        num_samples, columns = commit.rows, commit.columns
    else:
        sinks.save_dataset(kept, output)
        sinks.save_manifest(spark, output, input, name)
        recorded = sinks.read_manifest(spark, output).first()
        num_samples, columns = recorded["num_samples"], recorded["columns"]

    sample = quality.preview(readers.reload_saved(spark, output)).first()
    return PreparationReport(
        rows_before=read.get["rows"],
        rows_after=num_samples,
        columns=tuple(columns),
        sample=sample["preview"] if sample else None,
    )
