"""A metric roll-up that is kept up to date from the files that are new.

The state is a published dataset: partial sums per window and tag, and a ledger
of the files that are in them. Both are one version, so a file is in the sums
exactly if the ledger says so, whatever breaks off and whenever.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.operators import metrics
from loomset.sources import files, inventory, published, readers

_SUMS, _FILES = "sums", "files"


def fold_new_files(
    spark: SparkSession,
    source: str,
    state: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    as_log: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    every: str = "1 hour",
    time: str = "ts",
    tag: str = "tag",
    value: str = "value",
) -> int:
    """Add the files below ``source`` that no earlier run has folded in; returns how many.

    Only those are read, whatever their age and the times of their rows: rows
    that come late count in their window like any others. Files must not
    change: one whose size differs from when it was folded in is an error. If another run
    folds at the same time, one of the two ends with ``ConflictError`` and adds nothing. Without new
    files nothing is written. The ledger is one small row per file.
    """
    settings = {"every": every, "time": time, "tag": tag, "value": value}
    before = published.latest(spark, state)
    if before is not None and before.note != settings:
        raise ValueError(f"{state} was rolled up with {before.note}, not {settings}")
    known = _ledger(spark, state) if before else spark.createDataFrame([], inventory.SCHEMA)
    listed = _data_files(spark, source, file_format)
    both = listed.join(known.withColumnRenamed("length", "folded"), "path", "left")
    changed = [r["path"] for r in both.filter("folded != length").limit(5).collect()]
    if changed:
        raise ValueError(f"files have changed since they were rolled up: {changed}")
    new = both.filter("folded IS NULL").select("path", "length").collect()
    if not new:
        return 0
    rows = spark.read.schema(schema).format(file_format).options(**readers.FORMAT_OPTIONS.get(file_format, {}))
    log = as_log(rows.load([files.escape_glob(r["path"]) for r in new]))
    parts = metrics.partial_rollup(log, every, time, tag, value)
    if before:
        parts = _sums(spark, state).unionByName(parts)
    sums = metrics.merged_rollup(parts).withColumn("kind", F.lit(_SUMS))
    ledger = known.union(spark.createDataFrame(new, inventory.SCHEMA)).withColumn("kind", F.lit(_FILES))
    both = sums.unionByName(ledger, allowMissingColumns=True)
    published.publish(both, state, ["kind"], settings, after=before.version if before else 0)
    return len(new)


def rolled_up(spark: SparkSession, state: str) -> DataFrame:
    """The roll-up of all files folded in so far, as ``metrics.metric_rollup`` has it."""
    return metrics.finished_rollup(_sums(spark, state))


def _data_files(spark: SparkSession, source: str, file_format: str) -> DataFrame:
    name, suffixes = inventory.name_of("path"), readers.KINDS.get(file_format, (f".{file_format}",))
    wanted = F.concat(F.lit("."), F.substring_index(name, ".", -1)).isin(*suffixes)
    if not files.is_dir(spark, source):
        raise FileNotFoundError(f"there is no directory {source}")
    # What readers pass over: a name below the source that starts with a dot or an underscore.
    below = F.substring(F.col("path"), len(files.qualified(spark, source)) + 1, 1 << 20)
    return inventory.files_under(spark, source).filter(wanted & ~below.rlike(r"/[._][^/=]*(/|$)"))


def _sums(spark: SparkSession, state: str) -> DataFrame:
    return published.read_published(spark, state).filter(F.col("kind") == _SUMS).drop("kind", "path", "length")


def _ledger(spark: SparkSession, state: str) -> DataFrame:
    return published.read_published(spark, state).filter(F.col("kind") == _FILES).select("path", "length")
