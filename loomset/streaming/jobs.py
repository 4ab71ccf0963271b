"""Streams that read new files, render or roll up, and append to a table."""

from __future__ import annotations

from collections.abc import Callable
from posixpath import split

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loomset.functions.text import ref
from loomset.operators.metrics import metric_rollup
from loomset.plans.preparation import prepared_rows
from loomset.sources import files, readers


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """Files of a directory as they arrive; the schema must be given.

    A single file is streamed as its directory, filtered to its name.
    """
    reader = (
        spark.readStream.format(format)
        .schema(schema)
        .options(**{**readers.FORMAT_OPTIONS.get(format, {}), **options})
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if files.is_dir(spark, path):
        return reader.load(path)
    directory, name = split(path)
    return reader.option("pathGlobFilter", files.escape_glob(name)).load(directory)


def append_available(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Process what has arrived since the last run, append it, and stop.

    The checkpoint remembers which files were taken, so a repeated run adds
    nothing and a failed one goes on where it stopped.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(output)
    )
    query.awaitTermination()


def append_continuously(
    stream: DataFrame, output: str, checkpoint: str, every: str = "30 seconds"
) -> StreamingQuery:
    """Keep appending what arrives, looking again at the given interval, until stopped."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start(output)
    )


def prepare_stream(stream: DataFrame, format: str | Callable[..., Column], **options) -> DataFrame:
    """Render and filter a stream; stateless, the same expressions as for a table."""
    return prepared_rows(stream, format, **options)


def ingest_new_files(
    spark: SparkSession,
    input: str,
    output: str,
    checkpoint: str,
    schema: T.StructType | str,
    format: str | Callable[..., Column],
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options,
) -> None:
    """Render only the files that no earlier run has seen."""
    arrived = file_stream(spark, input, schema, file_format, max_files_per_trigger)
    append_available(prepare_stream(arrived, format, **options), output, checkpoint)


def metric_rollup_stream(
    log: DataFrame,
    every: str = "1 hour",
    delay: str = "10 minutes",
    time: str = "ts",
    tag: str = "tag",
    value: str = "value",
) -> DataFrame:
    """Windows are emitted once the watermark passes their end; later rows are dropped.

    State is one row per open window and tag.
    """
    timed = log.withColumn(time, ref(time).cast("timestamp"))
    return metric_rollup(timed.withWatermark(time, delay), every, time, tag, value)
