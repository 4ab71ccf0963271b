"""What lies below a path, as a table that executors fill.

``spark.read.format("file_inventory").load(path)`` has a row per file: ``path``
and ``length``. The driver only looks for enough directories to give each task
a few; their trees are walked by tasks, which pass rows on as they find them. So
neither the driver nor a task holds a list of files, and counts and sums of them
are ordinary aggregates.

Directories that are handed out are those of the first level that has enough of
them. One that holds nearly everything is one task's, as is a single flat
directory: a store lists that page by page in any case.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loomset.sources import files, stores

SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])

#: Directories that are handed out to tasks, if there are as many; and rows passed on together.
TREES, ROWS_AT_ONCE = 256, 10_000

_HEAD_BYTES = 4096


class Tree(InputPartition):
    """Directories, and whether what lies further below counts too."""

    def __init__(self, directories: Sequence[str], deep: bool):
        super().__init__(None)
        self.directories, self.deep = list(directories), deep


class InventoryReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.top = options["path"]
        self.options = dict(options)
        self.trees = int(options.get("trees", TREES))
        self.deep = options.get("recursive", "true").lower() == "true"

    def partitions(self) -> list[Tree]:
        """A first level with enough directories, or all levels; their parents count without what is below."""
        if not self.deep:
            return [Tree([self.top], deep=False)]
        store, shallow, level = stores.store_of(self.top, self.options), [], [self.top]
        while level and len(level) < self.trees:
            shallow += level
            level = [found.path for d in level for found in store.children(d) if found.is_dir]
            if len(shallow) >= self.trees:
                break
        level.sort()
        dealt = [level[i :: self.trees] for i in range(min(self.trees, len(level)))]
        flat = [shallow[i :: self.trees] for i in range(min(self.trees, len(shallow)))]
        return [Tree(d, deep=True) for d in dealt] + [Tree(d, deep=False) for d in flat]

    def read(self, tree: Tree) -> Iterator[pa.RecordBatch]:
        store = stores.store_of(self.top, self.options)
        paths, lengths = [], []

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], SCHEMA.names)
            paths.clear()
            lengths.clear()
            return made

        left = list(tree.directories)
        while left:
            for found in store.children(left.pop()):
                if found.is_dir:
                    if tree.deep:
                        left.append(found.path)
                    continue
                paths.append(found.path)
                lengths.append(found.length)
                if len(paths) == ROWS_AT_ONCE:
                    yield batch()
        yield batch()


class FileInventory(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_inventory"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> InventoryReader:
        return InventoryReader(self.options)


def store_options(spark: SparkSession, path: str) -> dict[str, str]:
    """Endpoint and region of an object store's bucket, as Hadoop's connector has them."""
    if not path.startswith("s3"):
        return {}
    bucket, conf = path.split("/")[2], spark._jsparkSession.sessionState().newHadoopConf()
    found = {}
    for name, key in (("endpoint", "endpoint"), ("region", "endpoint.region")):
        value = conf.get(f"fs.s3a.bucket.{bucket}.{key}") or conf.get(f"fs.s3a.{key}")
        if value:
            found[name] = value
    return found


def files_under(spark: SparkSession, directory: str, recursive: bool = True) -> DataFrame:
    """``path`` and ``length`` of all files below a directory, hidden ones too.

    Stores that only Hadoop's connectors open are listed by the driver instead.
    """
    top = files.qualified(spark, directory)
    if stores.opens(top):
        spark.dataSource.register(FileInventory)
        reader = spark.read.format("file_inventory").options(**store_options(spark, top), recursive=recursive)
        return reader.load(top)
    inside = files.list_dir(spark, top)
    found = files.files_below(spark, inside) if recursive else [e for e in inside if not e.is_dir]
    return spark.createDataFrame([(e.path, e.length) for e in found], SCHEMA)


def files_at(spark: SparkSession, paths: Sequence[str], tasks: int | None = None) -> DataFrame:
    """``path`` of the files among these paths (``named``), and of those directly in the directories among them.

    One table of the paths, dealt to some tasks, however many there are: neither the plan nor
    what tasks report grows with them. Stores that only Hadoop's connectors open are listed by the driver instead.
    """
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("named", T.BooleanType())])
    given = files.all_qualified(spark, paths)
    if not all(map(stores.opens, given)):
        return spark.createDataFrame(files.files_at(spark, given), schema)
    first_of = {urlsplit(p)[:2]: p for p in reversed(given)}
    options = {place: store_options(spark, p) for place, p in first_of.items()}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = {}
        for batch in batches:
            for path in batch.column(0).to_pylist():
                place = urlsplit(path)[:2]
                if place not in opened:
                    opened[place] = stores.store_of(path, options[place])
                yield from listed(opened[place], path)

    def listed(store: stores.Local | stores.Arrow, path: str) -> Iterator[pa.RecordBatch]:
        is_dir = store.is_dir(path)
        found = (f.path for f in store.children(path) if not f.is_dir) if is_dir else iter([path])
        while some := list(islice(found, ROWS_AT_ONCE)):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([not is_dir] * len(some))], schema.names)

    dealt = min(len(given), tasks or 2 * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame([(p,) for p in given], "path string").repartition(max(dealt, 1)).mapInArrow(look, schema)


def name_of(path) -> F.Column:
    """The last part of a path."""
    return F.substring_index(path, "/", -1)


def first_bytes(spark: SparkSession, paths: DataFrame, tasks: int | None = None) -> DataFrame:
    """``path`` and ``first``: each text file's first byte that is neither space nor byte order mark, null in an empty one.

    Tasks open the files, some each; stores that only Hadoop's connectors open are looked at from the driver instead.
    """
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("first", T.StringType())])
    one = paths.select("path").first()
    if one is None:
        return spark.createDataFrame([], schema)
    if not stores.opens(one["path"]):
        heads = files.first_bytes(spark, [r["path"] for r in paths.select("path").toLocalIterator()])
        return spark.createDataFrame([(p, b.decode("latin-1") or None) for p, b in heads.items()], schema)
    options = store_options(spark, one["path"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = None
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                store = store or stores.store_of(path, options)
                found.append(_first_byte(store, path))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], schema.names)

    dealt = paths.select("path").repartition(tasks or 2 * spark.sparkContext.defaultParallelism)
    return dealt.mapInArrow(look, schema)


def _first_byte(store: stores.Local | stores.Arrow, path: str) -> str | None:
    with store.open(path) as stream:
        start = True
        while buffer := stream.read(_HEAD_BYTES):
            if start:
                buffer, start = buffer.removeprefix(b"\xef\xbb\xbf"), False
            if text := buffer.lstrip():
                return text[:1].decode("latin-1")
    return None
