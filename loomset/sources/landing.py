"""Landing: copy a source to a target once, then check what lies there."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from posixpath import basename, dirname

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomset.sources import files, inventory, readers
from loomset.sources.sinks import save_dataset

# Partition that remembers which file or directory rows were landed from.
LANDED_FROM = "landed_from"


def s3_url(bucket: str, prefix: str = "") -> str:
    if not bucket:
        raise ValueError("a bucket is needed for source 's3'")
    return f"s3a://{bucket}/{prefix.lstrip('/')}"


def s3_options(bucket: str, endpoint_url: str | None = None, region: str | None = None) -> dict[str, str]:
    """Connector settings for one bucket: custom endpoint (with path-style access) and region."""
    options = {}
    if endpoint_url:
        options[f"fs.s3a.bucket.{bucket}.endpoint"] = endpoint_url
        options[f"fs.s3a.bucket.{bucket}.path.style.access"] = "true"
    if region:
        options[f"fs.s3a.bucket.{bucket}.endpoint.region"] = region
    return options


def read_prefix(
    spark: SparkSession,
    prefix: str,
    options: dict[str, str] | None = None,
    reading: readers.Reading = readers.Reading(),
    leave_out: Sequence[str] = (),
) -> DataFrame | None:
    """All files whose path starts with a string, at any depth and of any kind; ``None`` if there are none.

    As with object keys, ``data/a`` also matches ``data/ab/...``; a file named
    exactly like the prefix is left out. Directories ``key=value`` give columns,
    those that the prefix itself names included. See ``readers.read_tree``.
    """
    found = files.under_prefix(spark, prefix, options)
    if not found:
        return None
    root = prefix.rpartition("/")[0]
    while "=" in basename(root):
        root = dirname(root)
    return readers.read_tree(spark, found, root, reading, leave_out)


def save_landed(df: DataFrame, output: str, name: str, replace: bool = False) -> int:
    """Write rows below ``landed_from=<name>`` and return how many; the one layout of all landings.

    Rows landed before under the name are replaced, and with ``replace`` all
    others too. Raises if the target holds files that aren't landed, or if
    other than the rows read lie there afterwards.
    """
    spark = df.sparkSession
    if LANDED_FROM.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"landing names a column {LANDED_FROM!r}; rename the source's own")
    if not replace and files.exists(spark, output):
        plain = [e.path for e in files.list_dir(spark, output) if not _is_landed(e)]
        if plain:
            raise ValueError(f"{output} holds files beside landed ones, which readers would then pass over: {plain[:3]}")
    read = Observation("rows_landed")
    rows = df.observe(read, F.count(F.lit(1)).alias("rows")).withColumn(LANDED_FROM, F.lit(name))
    if replace:
        save_dataset(rows, output, partition_by=[LANDED_FROM])
    else:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(LANDED_FROM)
            .parquet(output)
        )
    expected = read.get["rows"]
    written = _rows_landed(spark, output, name) if expected else 0
    if written != expected:
        raise RuntimeError(f"{expected} rows were read and {written} lie in {output} as {name!r}")
    return written


def _is_landed(entry: files.Entry) -> bool:
    return (entry.is_dir and entry.name.startswith(f"{LANDED_FROM}=")) or entry.name in readers.BOOKKEEPING


def _rows_landed(spark: SparkSession, output: str, name: str) -> int:
    landed = spark.read.option("mergeSchema", True).parquet(files.escape_glob(output))
    return landed.filter(F.col(LANDED_FROM).cast("string") == name).count()


def land_local(
    spark: SparkSession,
    source: str,
    output: str,
    reading: readers.Reading = readers.Reading(),
    leave_out: Sequence[str] = (),
) -> int:
    """Land a directory, replacing the target, or a file, adding to it; returns the rows.

    A directory is landed whole: every level, every kind of file; what can't be
    read as data is an error, unless ``leave_out`` names it. Of a stream's
    output only committed files are taken. A file landed again replaces its
    earlier rows, so a repeated job does no harm. A directory with a file's
    suffix is a table as Spark writes it: landed whole too, but added like a file.
    """
    if not files.exists(spark, source):
        raise FileNotFoundError(f"there is nothing to land at {source}")
    name = basename(source.rstrip("/"))
    if not files.is_dir(spark, source):
        return save_landed(readers.read_file(spark, source, reading=reading), output, name)
    if files.is_dir(spark, f"{source}/_spark_metadata"):
        df = readers.reload_saved(spark, source)
    else:
        df = readers.read_tree(spark, files.list_dir(spark, source), source, reading, leave_out)
    return save_landed(df, output, name, replace=files.suffix_of(source) not in readers.DATA_SUFFIXES)


def land_once(spark: SparkSession, output: str, land: Callable[[], None]) -> bool:
    """Run ``land`` unless the target already holds a file; says whether it ran.

    Empty directories do not count as landed.
    """
    if files.holds_any_file(spark, output):
        return False
    land()
    return True


def landing_report(spark: SparkSession, path: str) -> DataFrame:
    """One row: number of files and total bytes. Raises if the target is missing or empty.

    Hidden names count too, but for marks of success and what a job that broke off left.
    """
    if not files.exists(spark, path):
        raise RuntimeError(f"nothing lies at {path}")
    found = landed_files(spark, path)
    if found.isEmpty():
        raise RuntimeError(f"{path} has no files")
    return found.agg(F.count(F.lit(1)).alias("num_files"), F.sum("length").alias("num_bytes"))


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``length`` of the files that count as landed, listed by executors."""
    marks = (inventory.name_of("path") == "_SUCCESS") | F.col("path").contains("/_temporary/")
    return inventory.files_under(spark, path).filter(~marks)


def landing_counters(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Files, bytes and rows of a landed dataset; for Parquet the rows come from footers."""
    sizes = landing_report(spark, path).withColumn("num_rows", F.lit(0))
    landed = spark.read.format(format).options(**readers.FORMAT_OPTIONS.get(format, {}))
    rows = (
        landed.load(files.escape_glob(path))
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .select(F.lit(0).alias("num_files"), F.lit(0).alias("num_bytes"), "num_rows")
    )
    counters = ("num_files", "num_bytes", "num_rows")
    return sizes.unionByName(rows).agg(*[F.sum(c).alias(c) for c in counters])
