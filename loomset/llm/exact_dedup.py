"""Exact deduplication with streaming state that never expires.

A streaming aggregation keeps, per digest and on disk (RocksDB), the stable
identifier of the row that stays, the locator of its content (file and row) and
the number of rows seen. New files can be added to the input at any time: a
restart with the same ``state`` folder meets the digests of all earlier ones.
Rows that hit a known digest are then compared with the keeper's content byte
by byte; texts that merely share a digest stay apart.

State holds one short row per distinct text. A digest that a third of all rows
share is summed up by each task before the shuffle. For the comparison texts are
shuffled once by their place, and those that have copies once more to their keeper.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import fresh, written
from loomset.session import scratch_dir
from loomset.sources.files import escape_glob

_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Small stores would each set aside several MB of disk for their logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "96",
}


#: How much older than the newest file a file may be that a stream still takes; Spark's default is a week.
_ANY_AGE = "36500d"


#: Reading options that leave files out, in lower case.
_NARROWING = {"pathglobfilter", "modifiedbefore", "modifiedafter", "recursivefilelookup", "ignorecorruptfiles", "ignoremissingfiles"}


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _located(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``file``, ``row``, ``content`` of each row of a table that lies in files."""
    return rows.select(
        F.col(key).alias("key"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("content"),
    )


def files_of(rows: DataFrame) -> tuple[DataFrame, str]:
    """A table in Parquet files, and the path that a stream reads them by.

    A whole table read from one file or from all files of one folder is taken where it lies; any
    other, and one read with options that leave files out, is first written to the shared scratch folder, so that rows have a lasting place.
    """
    files = []
    plan = rows._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() == "LogicalRelation" and "_metadata" not in rows.columns:
        files = rows.inputFiles()
        # A file that is named twice is read twice.
        if files and len(list(plan.relation().location().inputFiles())) != len(files):
            files = []
    folders = {f.rsplit("/", 1)[0] for f in files}
    if len(files) == 1:
        # A stream takes a single file only as a pattern; this one matches that file alone.
        return rows, f"{escape_glob(files[0][:-1])}[{files[0][-1]}]"
    if len(folders) == 1:
        folder = escape_glob(folders.pop())
        options = {name.lower() for name in plan.relation().options().keys().mkString("\n").split("\n")}
        whole = rows.sparkSession.read.schema(rows.schema).parquet(folder).inputFiles()
        if not options & _NARROWING and set(whole) == set(files):
            return rows, folder
    path = scratch_dir(rows.sparkSession, "dedup-input")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def keepers(
    stream: DataFrame, state: str, key: str, text: str, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """Run a stream of documents to its present end; return ``digest``, ``keep`` (key, file, row) and ``rows_seen``.

    ``state`` is a shared folder that holds the stream's progress and the
    changed keepers of each batch. A batch that runs again writes its own folder anew.
    """
    spark = stream.sparkSession
    found = (
        _located(stream, key, text)
        .groupBy(digest(F.col("content")).alias("digest"))
        .agg(F.max(F.struct("key", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("rows_seen"))
    )

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/keepers/batch={number}")

    earlier = {name: spark.conf.get(name, None) for name in _SETTINGS}
    try:
        for name, value in _SETTINGS.items():
            spark.conf.set(name, value)
        run = (
            found.writeStream.outputMode("update")
            .foreachBatch(save)
            .option("checkpointLocation", f"{state}/progress")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in earlier.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    run.awaitTermination()
    # Keepers only grow, so the greatest entry of a digest is its latest.
    return (
        spark.read.schema(found.schema)
        .option("recursiveFileLookup", "true")
        .parquet(f"{state}/keepers")
        .groupBy("digest")
        .agg(F.max("keep").alias("keep"), F.max("rows_seen").alias("rows_seen"))
    )


def exact_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    state: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Which row stays of each group of equal texts.

    Returns one row per input row: ``key``, ``keep_id`` (key of the row that
    stays, the largest of the group), ``group_size``, ``kept``, ``digest`` and
    the content's locator (``file``, ``row``). Null texts count as empty, and
    so equal each other. Of repeated rows with the largest key the one with the last locator stays
    alone; a null key is smaller than any other. An empty table gives no rows.

    ``state`` keeps the stream's folder for later runs over a grown table; by default it is new.
    Such a table must be one that is taken where it lies (see ``files_of``), as rows of a copy would count anew.
    ``files_per_batch`` cuts a long backlog into several batches.
    """
    spark = docs.sparkSession
    rows, path = files_of(docs)
    if state and rows is not docs:
        raise ValueError("a kept state needs a whole table in Parquet files of one folder")
    state = state or scratch_dir(spark, "dedup-state")
    source = spark.readStream.schema(rows.schema).option("maxFileAge", _ANY_AGE)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    if spark.read.schema(rows.schema).parquet(path).isEmpty():
        known = spark.createDataFrame([], f"digest string, keep struct<key: {rows.schema[key].dataType.simpleString()}, file: string, row: bigint>, rows_seen bigint")
    else:
        # Written before the join, so that Spark can split a digest that many rows share.
        known = written(keepers(source.parquet(path), state, key, text, digest), "dedup-keepers")
    located = _located(rows, key, text)
    here = located.withColumn("digest", digest(F.col("content"))).drop("content")
    # Every row was in the stream; one that it passed over must not vanish.
    passed_over = F.raise_error(F.concat(F.lit("the stream passed over rows of "), F.col("file")))
    found = written(
        here.join(known, "digest", "left").withColumn("rows_seen", F.coalesce("rows_seen", passed_over)), "dedup-found"
    )
    differing = _differing(located, found)
    same = found.withColumn("own", F.lit(None).cast("string"))
    if not differing.isEmpty():
        # Texts that share a digest but not their bytes: each text is a group of its own.
        apart = found.join(differing, ["file", "row"], "left")
        again = apart.groupBy("digest", "own").agg(
            F.max(F.struct("key", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("rows_seen")
        )
        same = (
            apart.drop("keep", "rows_seen")
            .alias("a")
            .join(
                again.alias("b"),
                (F.col("a.digest") == F.col("b.digest")) & F.col("a.own").eqNullSafe(F.col("b.own")),
            )
            .select("a.*", "b.keep", "b.rows_seen")
        )
    return same.select(
        F.col("key").alias(key),
        F.col("keep.key").alias("keep_id"),
        F.col("rows_seen").alias("group_size"),
        ((F.col("keep.file") == F.col("file")) & (F.col("keep.row") == F.col("row"))).alias("kept"),
        "digest",
        "file",
        "row",
    )


def _differing(located: DataFrame, found: DataFrame) -> DataFrame:
    """Rows whose text isn't, byte by byte, that of the keeper of their digest: ``file``, ``row``, ``own`` (the text)."""
    is_keeper = (F.col("keep.file") == F.col("file")) & (F.col("keep.row") == F.col("row"))
    shared = found.filter("rows_seen > 1").select("file", "row", "digest", is_keeper.alias("is_keeper"))
    contents = shared.join(located.select("file", "row", "content"), ["file", "row"])
    kept = contents.filter("is_keeper").select("digest", F.col("content").alias("kept_content"))
    hits = contents.filter("NOT is_keeper")
    return written(
        hits.join(kept, "digest").filter("content != kept_content").select("file", "row", F.col("content").alias("own")),
        "dedup-differing",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the rows whose equal stays; columns unchanged."""
    rows, _ = files_of(docs)
    gone = exact_dedup(rows, key, text).filter("NOT kept")
    file, row = fresh(rows, "file"), fresh(rows, "row")
    return rows.withColumns({file: F.col("_metadata.file_path"), row: F.col("_metadata.row_index")}).join(
        gone.select(F.col("file").alias(file), F.col("row").alias(row)), [file, row], "left_anti"
    ).drop(file, row)
