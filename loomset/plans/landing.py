"""Land a dataset: choose the source, skip if landed, write, verify."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from posixpath import basename

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from loomset.sources import landing, readers

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class LandingReport:
    landed: bool
    num_files: int | None = None
    num_bytes: int | None = None
    num_rows: int | None = None
    rows_landed: int | None = None
    columns: tuple[str, ...] | None = None


def land(
    spark: SparkSession,
    source: str,
    output: str,
    path: str | None = None,
    split: str = readers.DEFAULT_SPLIT,
    revision: str | None = None,
    bucket: str | None = None,
    prefix: str = "",
    endpoint_url: str | None = None,
    region: str | None = None,
    reading: readers.Reading = readers.Reading(),
    leave_out: Sequence[str] = (),
    skip_if_exists: bool = False,
    verify: bool = True,
) -> LandingReport:
    """Write the source's rows to ``output``.

    ``path`` is the exported hub table or the local file or directory;
    ``bucket`` and ``prefix`` name objects in a store. Whatever the source,
    rows lie below ``landed_from=<name>``, where the name is the path's or
    prefix's last part. A hub table and a directory replace the target, a file
    (or a directory named like one, as Spark writes tables) and a prefix add to
    it. ``reading`` says how JSON and CSV are read, and
    ``leave_out`` which files (by patterns of names) may stay behind. The rows
    written are counted against the rows read.
    """
    if source not in readers.SOURCES:
        raise ValueError(f"unknown source: {source!r}")
    if source == "s3" and not bucket:
        raise ValueError("a bucket is needed for source 's3'")
    if source != "s3" and not path:
        raise ValueError(f"a path is needed for source {source!r}")

    rows_landed = None

    def write() -> None:
        nonlocal rows_landed
        if source == "local":
            rows_landed = landing.land_local(spark, path, output, reading, leave_out)
            return
        if source == "huggingface":
            found, name = readers.read_source(spark, source, path, split, revision), basename(path.rstrip("/"))
        else:
            url = landing.s3_url(bucket, prefix)
            options = landing.s3_options(bucket, endpoint_url, region)
            found, name = landing.read_prefix(spark, url, options, reading, leave_out), basename(url.rstrip("/"))
        if found is None:
            logger.warning("nothing lies under s3://%s/%s", bucket, prefix)
        else:
            rows_landed = landing.save_landed(found, output, name, replace=source == "huggingface")

    if skip_if_exists:
        landed = landing.land_once(spark, output, write)
    else:
        write()
        landed = True
    if not verify:
        return LandingReport(landed, rows_landed=rows_landed)
    return _verified(spark, output, landed, rows_landed)


def _verified(spark: SparkSession, output: str, landed: bool, rows_landed: int | None) -> LandingReport:
    sizes = landing.landing_report(spark, output).first()
    try:
        df = readers.read_raw(spark, output)
        num_rows, columns = df.count(), tuple(df.columns)
    except (ValueError, AnalysisException):
        # Files that are not a dataset are still a landing.
        num_rows, columns = None, None
    return LandingReport(landed, sizes["num_files"], sizes["num_bytes"], num_rows, rows_landed, columns)
