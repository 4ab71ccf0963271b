"""Datasets that are replaced at once or not at all.

A published dataset is a directory of snapshots, each written whole and never
changed, and a log of commits that says which snapshot a version is. A commit is
one small file whose name is the version's number; it appears complete, and only
if no other has that name. So readers see the former version until the new one
is all there, a job that breaks off leaves nothing but a folder that no commit names, and
of two writers that start from the same version one fails.

The guarantee is the file system's: a rename that does not replace (HDFS and its
like) or a hard link (a local disk). On object stores without either, let one
job at a time publish to a path.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from posixpath import basename
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from loomset.sources import files

LOG = "_commits"


class ConflictError(RuntimeError):
    """Another job published first."""


@dataclass(frozen=True)
class Commit:
    version: int
    folder: str
    rows: int
    columns: Sequence[str]
    at: str
    note: Mapping[str, Any] = field(default_factory=dict)


def is_published(spark: SparkSession, path: str) -> bool:
    return _newest(spark, path) is not None


def latest(spark: SparkSession, path: str) -> Commit | None:
    """What the newest commit says; ``None`` where nothing is published."""
    newest = _newest(spark, path)
    return None if newest is None else commit_of(spark, path, newest)


def commit_of(spark: SparkSession, path: str, version: int) -> Commit:
    name = _commit_file(path, version)
    if not files.exists(spark, name):
        raise ValueError(f"no version {version} in {path}")
    return Commit(**json.loads(files.read_text(spark, name)))


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    note: Mapping[str, Any] | None = None,
    after: int | None = None,
) -> Commit:
    """Write rows as the next version; raises ``ConflictError`` if another job has published meanwhile.

    The version that the rows were made from can be named with ``after`` (0: none);
    otherwise it is the newest when writing starts. ``note`` is kept in the commit.
    The rows may come from the dataset's own former versions.
    """
    spark = df.sparkSession
    base = path.rstrip("/")
    before = (_newest(spark, path) or 0) if after is None else after
    folder = f"snapshot-{before + 1:08d}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{base}/{folder}")
    written = spark.read.parquet(files.escape_glob(f"{base}/{folder}"))
    made = datetime.now(timezone.utc).isoformat()
    commit = Commit(before + 1, folder, written.count(), df.columns, made, dict(note or {}))
    if not _write_once(spark, _commit_file(path, commit.version), json.dumps(asdict(commit))):
        raise ConflictError(f"version {commit.version} of {path} was published by another job; {folder} is not part of it")
    return commit


def publish_once(spark: SparkSession, path: str, make) -> bool:
    """Publish what ``make`` returns unless something is published already; says whether it was.

    What a broken job left does not count, and of two jobs that both find nothing one is told so.
    """
    if is_published(spark, path):
        return False
    try:
        publish(make(), path, after=0)
    except ConflictError:
        return False
    return True


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or one by number, as it was when it was published.

    A reader that has started stays with its version, whatever is published meanwhile.
    """
    commit = latest(spark, path) if version is None else commit_of(spark, path, version)
    if commit is None:
        raise ValueError(f"nothing is published in {path}")
    return spark.read.parquet(files.escape_glob(f"{path.rstrip('/')}/{commit.folder}")).select(*[f"`{c}`" for c in commit.columns])


def history(spark: SparkSession, path: str) -> DataFrame:
    """A row per version: ``version``, ``folder``, ``rows``, ``columns``, ``at``."""
    schema = "version long, folder string, rows long, columns array<string>, at string"
    return spark.read.schema(schema).json(files.escape_glob(f"{path.rstrip('/')}/{LOG}"))


def superseded(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Snapshots that none of the newest ``keep`` versions needs, those of broken jobs included; nothing is deleted.

    A job that is still writing has such a folder too.
    """
    newest = _newest(spark, path) or 0
    needed = {commit_of(spark, path, v).folder for v in range(max(newest - keep, 0) + 1, newest + 1)}
    return [e.path for e in files.list_dir(spark, path) if e.name.startswith("snapshot-") and e.name not in needed]


def _commit_file(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{LOG}/{version:020d}.json"


def _newest(spark: SparkSession, path: str) -> int | None:
    log = f"{path.rstrip('/')}/{LOG}"
    if not files.is_dir(spark, log):
        return None
    named = [basename(e.path) for e in files.list_dir(spark, log)]
    return max((int(n.removesuffix(".json")) for n in named if n.endswith(".json") and not n.startswith((".", "_"))), default=None)


def _write_once(spark: SparkSession, path: str, text: str) -> bool:
    """A file that appears with all of its text, or not at all if there is one of its name."""
    directory, name = path.rsplit("/", 1)
    draft = f"{directory}/.{name}.{uuid.uuid4().hex}"
    fs, jdraft = files.open_fs(spark, draft)
    stream = fs.create(jdraft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            plain = files.open_fs(spark, path)[1].toUri().getPath()
            try:
                os.link(jdraft.toUri().getPath(), plain)
            except FileExistsError:
                return False
            return True
        jvm = spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(jdraft, files.open_fs(spark, path)[1], none)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True
    finally:
        fs.delete(jdraft, False)
