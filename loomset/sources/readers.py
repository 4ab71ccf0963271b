"""Datasets as DataFrames, from files, directories, splits and versions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fnmatch import fnmatchcase
from functools import partial
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions.text import ref
from loomset.sources import files, inventory, positions, published

# Suffixes per kind, in the order a directory is probed.
JSON_SUFFIXES = (".json", ".jsonl")
PARQUET_SUFFIX = ".parquet"
CSV_SUFFIX = ".csv"
SOURCES = ("huggingface", "local", "s3")
DEFAULT_SPLIT = "train"


# Reader options per file format. Broken records fail; CSV quotes as RFC 4180 has it, and
# files whose headers differ are an error rather than read by the first one's.
FORMAT_OPTIONS = {
    "json": {"mode": "FAILFAST"},
    "csv": {
        "header": True,
        "multiLine": True,
        "quote": '"',
        "escape": '"',
        "mode": "FAILFAST",
        "enforceSchema": False,
    },
}

# Directories and files that Spark or this package writes beside the data.
BOOKKEEPING = ("_SUCCESS", "_spark_metadata", "_preparation_metadata", "_temporary", "_commits")

_SLICE = re.compile(r"(?P<name>[^\[\]]+)(?:\[(?P<start>-?\d+%?)?:(?P<stop>-?\d+%?)?\])?")


@dataclass(frozen=True)
class Reading:
    """How files are read, for whole jobs; see ``read_json`` and ``read_csv``."""

    layout: str = "auto"
    schema: T.StructType | str | None = None
    multi_line: bool = True
    na_values: Sequence[str] = ()
    infer_types: bool = False


def _paths(path: str | Sequence[str]) -> list[str]:
    return [files.escape_glob(p) for p in ([path] if isinstance(path, str) else path)]


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    layout: str = "auto",
    suffixes: Sequence[str] = (),
    places: tuple[str, str, str] | None = None,
) -> DataFrame:
    """JSON Lines or JSON arrays; a broken record fails the read.

    Lines are split over tasks, an array is read whole by one task. ``auto``
    looks at the first byte of every file, in executors; name the layout to
    skip this.
    Arrays that each fill a line are read by lines too, several to a file.
    Give ``schema`` to save the inference pass.
    ``suffixes`` limits the files taken from a directory. ``places`` names three
    columns to add: a row's file, its part of the file, and its place in that part.
    """
    if layout not in ("auto", "lines", "array"):
        raise ValueError(f"layout must be auto, lines or array, got {layout!r}")
    given = [path] if isinstance(path, str) else list(path)
    if layout == "array":
        lines, arrays = [], given
    elif layout == "lines":
        lines, arrays = given, []
    else:
        lines, arrays = _by_layout(spark, given, suffixes)

    def load(paths: list[str], multi_line: bool) -> DataFrame:
        reader = _only(spark.read, suffixes).options(**FORMAT_OPTIONS["json"], multiLine=multi_line)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.json(_paths(paths))

    def load_arrays(paths: list[str]) -> DataFrame:
        if layout == "auto" and schema is None:
            # A line that is no record of its own shows up as a column of this name.
            probe = _only(spark.read, suffixes).option("columnNameOfCorruptRecord", "_unreadable")
            found = probe.json(_paths(paths)).schema
            if "_unreadable" not in found.names:
                strict = _only(spark.read, suffixes).options(**FORMAT_OPTIONS["json"])
                return strict.schema(found).json(_paths(paths))
        return load(paths, multi_line=True)

    parts = [read(p) for p, read in ((lines, partial(load, multi_line=False)), (arrays, load_arrays)) if p]
    if not parts:
        raise ValueError(f"no JSON files in {given}")
    if places:
        parts = [placed(p, places) for p in parts]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def placed(df: DataFrame, names: tuple[str, str, str]) -> DataFrame:
    """Rows with the file they come from, the start of their part of it, and their place in the part."""
    at = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return df.select("*", *[value.alias(name) for name, value in zip(names, at)])


def _by_layout(
    spark: SparkSession, given: list[str], suffixes: Sequence[str]
) -> tuple[list[str], list[str]]:
    """Paths to read by lines, and as arrays. Executors open the files; the driver lists them only if both kinds are there."""
    found = _data_files_of(inventory.files_at(spark, given), suffixes or None)
    heads = inventory.first_bytes(spark, found)
    is_array = F.coalesce(F.col("first") == "[", F.lit(False))
    counted = heads.agg(F.count(F.lit(1)).alias("all"), F.count_if(is_array).alias("arrays")).first()
    if not counted["arrays"]:
        return given, []
    if counted["arrays"] == counted["all"]:
        return [], given
    told = heads.select("path", is_array.alias("is_array")).collect()
    return [r["path"] for r in told if not r["is_array"]], [r["path"] for r in told if r["is_array"]]


def _data_files_of(listed: DataFrame, suffixes: Sequence[str] | None) -> DataFrame:
    """``data_files`` of a table of paths; those marked as ``named`` are taken whatever their name."""
    name, named = inventory.name_of("path"), F.col("named")
    wanted = ~name.isin(*BOOKKEEPING)
    if suffixes is not None:
        wanted &= F.concat(F.lit("."), F.substring_index(name, ".", -1)).isin(*suffixes) & name.contains(".")
    hidden = ~named & (name.startswith(".") | (name.startswith("_") & ~name.contains("=")))
    chosen = listed.filter(named | wanted)
    if suffixes is not None:
        passed = [r["path"] for r in chosen.filter(hidden).limit(6).collect()]
        if passed:
            raise ValueError(f"readers pass over hidden names; rename these files: {_some(passed)}")
    return chosen.filter(~hidden)


def data_files(entries: Sequence[files.Entry], suffixes: Sequence[str] | None = None) -> list[files.Entry]:
    """The files of these suffixes (``None``: of any). One that Spark would pass over for its name is an error."""
    wanted = [
        e
        for e in entries
        if not e.is_dir
        and e.name not in BOOKKEEPING
        and (suffixes is None or files.suffix_of(e.name) in suffixes)
    ]
    hidden = [e.path for e in wanted if files.is_hidden(e.name)]
    if hidden and suffixes is not None:
        raise ValueError(f"readers pass over hidden names; rename these files: {_some(hidden)}")
    return [e for e in wanted if not files.is_hidden(e.name)]


def _some(paths: Sequence[str]) -> str:
    return ", ".join(paths[:5]) + (f" and {len(paths) - 5} more" if len(paths) > 5 else "")


def _only(reader: DataFrameReader, suffixes: Sequence[str]) -> DataFrameReader:
    return reader.option("pathGlobFilter", "*{" + ",".join(suffixes) + "}") if suffixes else reader


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], suffixes: Sequence[str] = ()
) -> DataFrame:
    return _only(spark.read, suffixes).parquet(*_paths(path))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    multi_line: bool = True,
    na_values: Sequence[str] = (),
    infer_types: bool = False,
    suffixes: Sequence[str] = (),
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """CSV with a header; columns are strings, so texts stay as they were written.

    Quoted newlines need ``multi_line``, which makes one task read a whole
    file; turn it off for large files that have none. Values in ``na_values``
    become null. ``infer_types`` reads the data once more beforehand and turns
    numbers and truth values into such, so that ``1.50`` prints as ``1.5``;
    dates stay strings.
    """
    options = {**FORMAT_OPTIONS["csv"], "multiLine": multi_line}
    reader = _only(spark.read, suffixes).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_types:
        found = reader.option("inferSchema", True).csv(_paths(path)).schema
        reader = reader.schema(T.StructType([_undated(f) for f in found.fields]))
    df = reader.csv(_paths(path))
    if not na_values:
        return df
    return df.select(
        *[F.when(~ref(c).cast("string").isin(*na_values), ref(c)).alias(c) for c in df.columns]
    )


def _undated(field: T.StructField) -> T.StructField:
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return T.StructField(field.name, T.StringType())
    return field


def is_saved_dataset(spark: SparkSession, path: str) -> bool:
    """A Parquet directory our sinks or streams completed: marked so, or made of partitions only.

    Landing single files replaces partitions, which leaves no mark at the top.
    """
    base = path.rstrip("/")
    if files.is_dir(spark, f"{base}/_spark_metadata") or published.is_published(spark, base):
        return True
    if files.exists(spark, f"{base}/_SUCCESS") and files.first_match(spark, base, PARQUET_SUFFIX):
        return True
    inside = files.list_dir(spark, base)
    partitions = [e.path for e in inside if e.is_dir and "=" in e.name]
    if not partitions or any(not e.is_dir and not files.is_hidden(e.name) for e in inside):
        return False
    return any(files.first_match(spark, d, PARQUET_SUFFIX, recursive=True) for d in partitions)


def reload_saved(spark: SparkSession, path: str, merge_schemas: bool = True) -> DataFrame:
    """A saved dataset; of a stream's output only what the stream committed, of a published one the newest version.

    Files may differ in their columns; all columns are there, null where a file
    lacks them. That reads all footers, in a job; without ``merge_schemas`` one
    file's columns are taken for all.
    """
    if not is_saved_dataset(spark, path):
        raise ValueError(f"not a saved dataset: {path}")
    if published.is_published(spark, path):
        return published.read_published(spark, path)
    return spark.read.option("mergeSchema", merge_schemas).parquet(files.escape_glob(path))


# Kinds of files, in the order a directory is probed.
KINDS = {"json": JSON_SUFFIXES, "parquet": (PARQUET_SUFFIX,), "csv": (CSV_SUFFIX,)}
DATA_SUFFIXES = frozenset(s for suffixes in KINDS.values() for s in suffixes)


def read_file(
    spark: SparkSession, path: str, strict: bool = True, reading: Reading = Reading()
) -> DataFrame:
    """One file by its suffix. Unknown suffixes raise, or are read as CSV if not strict."""
    suffix = files.suffix_of(path)
    for suffixes in KINDS.values():
        if suffix in suffixes:
            return read_kind(spark, path, suffixes, reading, whole=True)
    if not strict:
        return read_kind(spark, path, KINDS["csv"], reading, whole=True)
    raise ValueError(f"unsupported file format: {suffix!r}")


def read_kind(
    spark: SparkSession,
    path: str | Sequence[str],
    suffixes: Sequence[str],
    reading: Reading = Reading(),
    whole: bool = False,
    places: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Files of one kind: those of these suffixes in a directory, or just the ones named (``whole``)."""
    chosen = () if whole else suffixes
    if suffixes == JSON_SUFFIXES:
        return read_json(spark, path, reading.schema, reading.layout, chosen, places)
    if suffixes == (PARQUET_SUFFIX,):
        df = read_parquet(spark, path, chosen)
    else:
        df = read_csv(
            spark, path, reading.multi_line, reading.na_values, reading.infer_types, chosen, reading.schema
        )
    return placed(df, places) if places else df


def read_raw(
    spark: SparkSession,
    path: str,
    reading: Reading = Reading(),
    places: tuple[str, str, str] | None = None,
) -> DataFrame:
    """A file by suffix, or a directory by what it holds.

    A directory is taken as a saved dataset, else its JSON files are read, else
    its Parquet, else its CSV files: one kind only, not its subdirectories.
    ``places`` are those of ``read_json``.
    """
    if not files.is_dir(spark, path):
        df = read_file(spark, path, reading=reading)
        return placed(df, places) if places else df
    if is_saved_dataset(spark, path):
        df = reload_saved(spark, path)
        return placed(df, places) if places else df
    inside = files.list_dir(spark, path)
    for suffixes in KINDS.values():
        matching = data_files(inside, suffixes)
        if matching and any(e.is_dir for e in inside):
            return read_kind(spark, [e.path for e in matching], suffixes, reading, whole=True, places=places)
        if matching:
            return read_kind(spark, path, suffixes, reading, places=places)
    raise ValueError(f"no supported data files in {path}")


def read_tree(
    spark: SparkSession,
    tops: Sequence[files.Entry],
    root: str,
    reading: Reading = Reading(),
    leave_out: Sequence[str] = (),
) -> DataFrame:
    """All data files among these files and below these directories, of every kind, as one table.

    Columns are joined by name, null where a file lacks them; directories named
    ``key=value`` below ``root`` give columns. Nothing is passed over: a file of
    another kind, or with a name that readers skip, is an error unless a
    pattern of ``leave_out`` matches its name.
    """
    start = len(files.qualified(spark, root).rstrip("/")) + 1
    found = [e for e in files.files_below(spark, list(tops)) if not _is_bookkeeping(e.path[start:].split("/"))]
    found = [e for e in found if not any(fnmatchcase(e.name, pattern) for pattern in leave_out)]
    below = {e.path: e.path[start:].split("/") for e in found}
    left = [p for p, names in below.items() if files.suffix_of(p) not in DATA_SUFFIXES or any(map(files.is_hidden, names))]
    if left:
        raise ValueError(f"of no known kind, or hidden by name (leave_out says what may stay behind): {_some(left)}")
    parts = []
    keys = sorted({p.split("=", 1)[0] for names in below.values() for p in names[:-1] if "=" in p})
    for suffixes in KINDS.values():
        matching = [e.path for e in found if files.suffix_of(e.name) in suffixes]
        if matching:
            reader = spark.read.option("mergeSchema", True)
            if suffixes == (PARQUET_SUFFIX,):
                df = reader.parquet(*_paths(matching))
            else:
                df = read_kind(spark, matching, suffixes, reading, whole=True, places=None)
            parts.append(_with_directories(df, keys, below))
    if not parts:
        raise ValueError(f"no data files in {root}")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def _is_bookkeeping(below: Sequence[str]) -> bool:
    return any(part in BOOKKEEPING for part in below)


def _with_directories(df: DataFrame, keys: Sequence[str], below: Mapping[str, list[str]]) -> DataFrame:
    """Values of ``key=value`` directories as columns: whole numbers where all are, else strings."""
    if not keys:
        return df
    if not positions.knows_files(df):
        raise ValueError("JSON lines and arrays can't be mixed below partition directories; land them apart")
    path = F.col("_metadata.file_path")
    columns = []
    for key in keys:
        if key in df.columns:
            raise ValueError(f"a directory and the files name the same column: {key!r}")
        values = {p.split("=", 1)[1] for names in below.values() for p in names[:-1] if p.startswith(f"{key}=")}
        values.discard(_NULL_DIRECTORY)
        # The path is written as a URL, and names within it as Spark escapes them.
        value = _decoded(_decoded(F.regexp_extract(path, f"/{re.escape(quote(key))}=([^/]*)/", 1)))
        value = F.when(~value.isin("", _NULL_DIRECTORY), value)
        numeric = values and all(re.fullmatch(r"-?\d{1,18}", unquote(v)) for v in values)
        columns.append((value.cast("long") if numeric else value).alias(key))
    return df.select("*", *columns)


def _decoded(name: Column) -> Column:
    """Escapes undone, where all percent signs are escapes; a plus sign is one, not a space."""
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


_NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"


def read_source(
    spark: SparkSession,
    source: str = "huggingface",
    path: str | None = None,
    split: str = DEFAULT_SPLIT,
    revision: str | None = None,
    reading: Reading = Reading(),
) -> DataFrame:
    """The training table of a source kind.

    ``huggingface`` is a hub dataset already exported to a path, by split and
    optionally by revision. ``local`` goes by suffix (a directory is a saved
    dataset, any other suffix is CSV). ``s3`` is a saved dataset.
    """
    if source not in SOURCES:
        raise ValueError(f"unknown dataset source: {source!r}")
    if not path:
        raise ValueError(f"a path is needed for source {source!r}")
    if source == "huggingface":
        if revision is not None:
            path = version_path(spark, path, revision)
        return select_split(spark, path, split)
    if source == "s3":
        return reload_saved(spark, path)
    if files.suffix_of(path) in (*JSON_SUFFIXES, PARQUET_SUFFIX):
        return read_file(spark, path, reading=reading)
    if files.is_dir(spark, path):
        return reload_saved(spark, path)
    return read_file(spark, path, strict=False, reading=reading)


def select_split(spark: SparkSession, path: str, split: str = DEFAULT_SPLIT) -> DataFrame:
    """Splits of a table partitioned by ``split``, by name; other splits are not opened.

    Also slices of a split by position or percentage, as ``train[:100]``,
    ``train[10:20]``, ``test[-5:]`` or ``train[:10%]``, and sums, as
    ``train+test[:50%]``. Positions count by file and row; bounds beyond a split's end
    mean its end, percentages round to the nearest row. Unknown names raise.
    """
    df = spark.read.parquet(files.escape_glob(path))
    chosen = [_one_split(df, path, part.strip()) for part in split.split("+")]
    whole = chosen[0]
    for part in chosen[1:]:
        whole = whole.union(part)
    return whole


def _one_split(df: DataFrame, path: str, wanted: str) -> DataFrame:
    parsed = _SLICE.fullmatch(wanted)
    if not parsed:
        raise ValueError(f"not a split or a slice of one: {wanted!r}")
    name, start, stop = parsed["name"], parsed["start"], parsed["stop"]
    if "split" in df.columns:
        rows = df.filter(F.col("split") == name)
        if rows.isEmpty():
            known = sorted(str(r[0]) for r in df.select("split").distinct().limit(20).collect())
            raise ValueError(f"no split {name!r} in {path}; there are {known}")
    elif name == DEFAULT_SPLIT:
        rows = df
    else:
        raise ValueError(f"{path} has no splits, so none named {name!r}")
    if start is None and stop is None:
        return rows
    total = rows.count()

    def bound(given: str | None, default: int) -> int:
        if given is None:
            return default
        at = round(int(given[:-1]) * total / 100) if given.endswith("%") else int(given)
        return min(max(at + total, 0) if at < 0 else at, total)

    return positions.rows_between(rows, bound(start, 0), bound(stop, total))


def version_path(spark: SparkSession, path: str, version: str) -> str:
    """The directory of a version: ``version=<v>`` or plainly ``<v>``."""
    for name in (f"version={version}", version):
        candidate = f"{path.rstrip('/')}/{name}"
        if files.is_dir(spark, candidate):
            return candidate
    raise ValueError(f"no version {version!r} in {path}")


def read_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    """A pinned version, with its name as a string column; others are not even listed."""
    df = spark.read.parquet(files.escape_glob(version_path(spark, path, version)))
    return df.withColumn("version", F.lit(version))
