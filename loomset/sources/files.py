"""Questions to the file system, through Hadoop so that any store works.

Everything here runs on the driver and touches names and sizes, plus the first
bytes of JSON files; data is read by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from posixpath import basename, splitext

from pyspark.sql import SparkSession

_PEEK_THREADS = 16
_PEEK_BYTES = 4096
_QUALIFIED = re.compile(r"file:/|[A-Za-z][A-Za-z0-9+.-]*://[^/]")
_STATUS = re.compile(r"path=(.*?); isDirectory=(true|false)(?:; length=(\d+))?", re.S)


def escape_glob(path: str) -> str:
    """Make a literal path safe where Spark would expand patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def suffix_of(path: str) -> str:
    return splitext(basename(path.rstrip("/")))[1]


def open_fs(spark: SparkSession, path: str, options: Mapping[str, str] | None = None):
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for key, value in (options or {}).items():
        conf.set(key, value)
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(conf), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = open_fs(spark, path)
    return fs.exists(jpath)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, jpath = open_fs(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings write it, scheme included."""
    fs, jpath = open_fs(spark, path)
    return fs.makeQualified(jpath).toString()


def all_qualified(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """``qualified`` for many paths; those that name their store, as listings do, cost no call to the JVM."""
    return [p if _QUALIFIED.match(p) else qualified(spark, p) for p in paths]


def holds_any_file(spark: SparkSession, path: str) -> bool:
    """Whether a file lies anywhere below, but for what a job that broke off left; stops at the first one."""
    fs, jpath = open_fs(spark, path)
    if not fs.exists(jpath):
        return False
    found = fs.listFiles(jpath, True)
    while found.hasNext():
        if "/_temporary/" not in found.next().getPath().toString():
            return True
    return False


@dataclass(frozen=True)
class Entry:
    path: str
    is_dir: bool
    length: int

    @property
    def name(self) -> str:
        return basename(self.path)


def is_hidden(name: str) -> bool:
    """Whether Spark's readers pass a file or directory of this name over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _entries(spark: SparkSession, statuses) -> list[Entry]:
    """File statuses as one text from the JVM: a single call, however many there are."""
    if not statuses:
        return []
    told = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(statuses)
    found = [Entry(p, d == "true", int(n or 0)) for p, d, n in _STATUS.findall(told)]
    if len(found) != len(statuses):
        raise RuntimeError("the file system describes its files in an unknown way")
    return sorted(found, key=lambda e: e.path)


def list_dir(spark: SparkSession, directory: str) -> list[Entry]:
    """What lies directly in a directory, hidden names too, sorted by path."""
    fs, jpath = open_fs(spark, directory)
    return _entries(spark, fs.listStatus(jpath))


def files_at(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, bool]]:
    """Files among these paths, marked true, and those directly in the directories among them, marked false."""

    def look(path: str) -> list[tuple[str, bool]]:
        own = qualified(spark, path)
        return [(e.path, e.path == own) for e in list_dir(spark, path) if not e.is_dir]

    with ThreadPoolExecutor(_PEEK_THREADS) as pool:
        return [found for part in pool.map(look, paths) for found in part]


def files_below(spark: SparkSession, top: list[Entry]) -> list[Entry]:
    """These files and all files below these directories; one call to the JVM per directory."""
    found = [e for e in top if not e.is_dir]
    level = [e for e in top if e.is_dir]
    with ThreadPoolExecutor(_PEEK_THREADS) as pool:
        while level:
            inside = [e for part in pool.map(lambda e: list_dir(spark, e.path), level) for e in part]
            found += [e for e in inside if not e.is_dir]
            level = [e for e in inside if e.is_dir]
    return sorted(found, key=lambda e: e.path)


def first_match(spark: SparkSession, directory: str, suffix: str, recursive: bool = False) -> bool:
    """Whether a file of this suffix lies in a directory; stops at the first."""
    fs, jpath = open_fs(spark, directory)
    found = fs.listFiles(jpath, recursive)
    while found.hasNext():
        if found.next().getPath().getName().endswith(suffix):
            return True
    return False


def under_prefix(
    spark: SparkSession, prefix: str, options: Mapping[str, str] | None = None
) -> list[Entry]:
    """Files and directories whose path starts with a string, but for a file that equals it."""
    fs, pattern = open_fs(spark, escape_glob(prefix) + "*", options)
    itself = spark._jvm.org.apache.hadoop.fs.Path(prefix.rstrip("/") or "/")
    exact = fs.makeQualified(itself).toString()
    return [e for e in _entries(spark, fs.globStatus(pattern)) if e.is_dir or e.path != exact]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole."""
    fs, jpath = open_fs(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def first_byte(spark: SparkSession, path: str) -> bytes:
    """The first byte of a text file that is neither space nor byte order mark."""
    fs, jpath = open_fs(spark, path)
    stream = fs.open(jpath)
    try:
        while True:
            buffer = bytes(stream.readNBytes(_PEEK_BYTES))
            if not buffer:
                return b""
            text = buffer.removeprefix(b"\xef\xbb\xbf").lstrip()
            if text:
                return text[:1]
    finally:
        stream.close()


def first_bytes(spark: SparkSession, paths: list[str]) -> dict[str, bytes]:
    with ThreadPoolExecutor(_PEEK_THREADS) as pool:
        return dict(zip(paths, pool.map(lambda p: first_byte(spark, p), paths)))
