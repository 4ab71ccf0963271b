"""Exported shards read from any step on, by an index of which positions lie in which file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.sources import files

# Underscored, so that no reader takes it for data.
INDEX_DIR = "_positions"

_INDEX = "rank long, file string, first long, last long, rows long"


def save_index(spark: SparkSession, path: str, position: str = "position") -> None:
    """Write the range of positions of every file beside the shards; reads that one column.

    Files are known by their place below ``path``, so the shards can be moved with it.
    """
    top = files.qualified(spark, path).rstrip("/")
    shards = spark.read.parquet(files.escape_glob(path))
    (
        shards.groupBy(F.col("rank").cast("long").alias("rank"), F.col("_metadata.file_path").alias("file"))
        .agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count(F.lit(1)).alias("rows"))
        .withColumn("file", _below(F.col("file")))
        .write.mode("overwrite")
        .parquet(f"{top}/{INDEX_DIR}")
    )


def _below(file):
    """From ``rank=`` on: a file's place below the shards, escapes of the URL undone."""
    return F.try_url_decode(F.replace(F.regexp_extract(file, "(rank=[^/]*/[^/]*)$", 1), F.lit("+"), F.lit("%2B")))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``rank``, ``file``, ``first`` and ``last`` position, ``rows``: a row per file."""
    return spark.read.schema(_INDEX).parquet(files.escape_glob(f"{path.rstrip('/')}/{INDEX_DIR}"))


def first_position(step: int, rank: int, world_size: int, per_device_batch: int, accumulation: int) -> int:
    """Where a rank's rows of an optimizer step of the stored order begin."""
    return step * accumulation * per_device_batch * world_size + rank


def read_from_step(
    spark: SparkSession,
    path: str,
    step: int,
    world_size: int,
    per_device_batch: int = 2,
    accumulation: int = 4,
    rank: int | None = None,
    stop: int | None = None,
    position: str = "position",
) -> DataFrame:
    """Shards (or one rank's) from a step on, up to but not including ``stop``: what a resumed run has yet to see.

    Only files that hold such positions are opened; in the first of them, row
    groups before the step are skipped by the filter on the position. Steps are those of
    ``order.assign_batches`` over the stored order; ``world_size`` must be the one the shards were written for. A
    step beyond the end has no rows.
    """
    if step < 0 or (stop is not None and stop < step):
        raise ValueError(f"no steps from {step} to {stop}")
    index = read_index(spark, path)
    held = index.agg(F.max("rank")).first()[0]
    if held is not None and held >= world_size:
        raise ValueError(f"the shards are for more than {world_size} ranks")
    if rank is not None:
        index = index.filter(F.col("rank") == rank)
    start = first_position(step, 0, world_size, per_device_batch, accumulation)
    end = None if stop is None else first_position(stop, 0, world_size, per_device_batch, accumulation)
    wanted = F.col("last") >= start
    if end is not None:
        wanted &= F.col("first") < end
    chosen = [r["file"] for r in index.filter(wanted).select("file").collect()]
    base = path.rstrip("/")
    whole = spark.read.parquet(files.escape_glob(path))
    if not chosen:
        return whole.limit(0)
    shards = spark.read.schema(whole.schema).option("basePath", base).parquet(*[files.escape_glob(f"{base}/{f}") for f in chosen])
    rows = shards.filter(F.col(f"`{position}`") >= start)
    return rows if end is None else rows.filter(F.col(f"`{position}`") < end)
