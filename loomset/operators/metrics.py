"""Roll-ups of training metric logs: rows of run, step, time, tag and value."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.functions.text import ref


def metric_rollup(
    log: DataFrame, every: str = "1 hour", time: str = "ts", tag: str = "tag", value: str = "value"
) -> DataFrame:
    """Count, mean, least and greatest value per time window and tag.

    Works on a batch table and, once it carries a watermark, on a stream.
    """
    grouped = log.groupBy(F.window(ref(time), every).alias("_window"), ref(tag).alias("tag")).agg(
        F.count(ref(value)).alias("points"),
        F.avg(ref(value)).alias("mean_value"),
        F.min(ref(value)).alias("min_value"),
        F.max(ref(value)).alias("max_value"),
    )
    return grouped.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        "tag",
        "points",
        "mean_value",
        "min_value",
        "max_value",
    )


def partial_rollup(
    log: DataFrame, every: str = "1 hour", time: str = "ts", tag: str = "tag", value: str = "value"
) -> DataFrame:
    """What a part of a log adds to ``metric_rollup``: counts and sums, which parts of it can be added to."""
    grouped = log.groupBy(F.window(ref(time), every).alias("_window"), ref(tag).alias("tag")).agg(
        F.count(ref(value)).alias("points"),
        F.sum(ref(value).cast("double")).alias("total"),
        F.min(ref(value)).alias("min_value"),
        F.max(ref(value)).alias("max_value"),
    )
    window = [F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end")]
    return grouped.select(*window, "tag", "points", "total", "min_value", "max_value")


def merged_rollup(parts: DataFrame) -> DataFrame:
    """One row for the parts of each window and tag."""
    return parts.groupBy("window_start", "window_end", "tag").agg(
        F.sum("points").alias("points"),
        F.sum("total").alias("total"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )


def finished_rollup(parts: DataFrame) -> DataFrame:
    """Merged parts as ``metric_rollup`` has them."""
    mean = F.when(F.col("points") > 0, F.col("total") / F.col("points"))
    return parts.select("window_start", "window_end", "tag", "points", mean.alias("mean_value"), "min_value", "max_value")


def latest_metrics(
    log: DataFrame,
    tags: Sequence[str],
    run: str = "run_id",
    step: str = "step",
    tag: str = "tag",
    value: str = "value",
    decimals: int = 4,
    time: str = "ts",
) -> DataFrame:
    """One row per run with each tag's last value as text, ``N/A`` where it has none.

    The last is the one of the latest time, of equal times the greatest step,
    of those the greatest value. Numbers are rounded as Python prints them, from their
    exact binary value; that runs in Python, on one row per run.
    """

    def last(name: str):
        of_tag = (ref(tag) == F.lit(name)) & ref(value).isNotNull()
        return F.max(F.when(of_tag, F.struct(ref(time).alias("t"), ref(step).alias("s"), ref(value).alias("v"))))["v"]

    def show(values: pa.Array) -> pa.Array:
        return pa.array(["N/A" if v is None else f"{v:.{decimals}f}" for v in values.to_pylist()], pa.string())

    shown = F.arrow_udf(show, "string")
    # Runs that have none of the tags still get a row.
    ends = log.groupBy(ref(run)).agg(*[last(name).cast("double").alias(name) for name in tags])
    return ends.select(ref(run), *[shown(ref(name)).alias(name) for name in tags])
