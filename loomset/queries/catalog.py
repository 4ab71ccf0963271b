"""The queries, by name. Each takes a session and a directory of tables."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.functions import formats
from loomset.functions.text import blank
from loomset.operators import detect, lengths, metrics, order, quality, render, retention, selection, turns
from loomset.plans import landing as landing_plan
from loomset.plans import preparation, rollup, training
from loomset.queries import adapters as a
from loomset.session import scratch_dir
from loomset.sources import files, landing, published, readers, shards, sinks
from loomset.streaming import conversations, jobs

CONV_KEYS = ("conv_id", "turn")
DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
METRIC_TAGS = ("click", "error", "purchase", "signup", "view", "train_loss")
EXPERT = "You are a domain expert."


# --- sources -----------------------------------------------------------------


def scan_source(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "scan-source")
    sinks.save_dataset(a.documents(spark, sf), path)
    return readers.read_source(spark, "local", path).select(*DOC_COLUMNS)


def scan_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "scan-json")
    a.documents(spark, sf).write.json(path)
    return readers.read_raw(spark, path).select(*DOC_COLUMNS)


def scan_json_array(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays of up to 250 documents, one per file."""
    path = scratch_dir(spark, "scan-json-array")
    (
        a.documents(spark, sf)
        .groupBy(F.floor(F.col("doc_id") / 250).alias("chunk"))
        .agg(F.to_json(F.collect_list(F.struct(*DOC_COLUMNS))).alias("value"))
        .write.partitionBy("chunk")
        .text(path)
    )
    found = [e.path for e in files.under_prefix(spark, f"{path}/chunk=")]
    return readers.read_json(spark, found).select(*DOC_COLUMNS)


def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_file(spark, f"{sf}/documents.parquet").select(*DOC_COLUMNS)


def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "scan-csv")
    a.documents(spark, sf).write.options(
        header=True,
        quoteAll=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return readers.read_raw(spark, path).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        "lang",
        "source",
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def scan_dir_priority(spark: SparkSession, sf: str) -> DataFrame:
    """JSON next to Parquet in one directory without a success mark: the JSON is read."""
    path = scratch_dir(spark, "scan-dir")
    unmarked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    a.documents(spark, sf).write.options(**unmarked).json(path)
    a.table(spark, sf, "benchmark").write.options(**unmarked).mode("append").parquet(path)
    return readers.read_raw(spark, path).select(*DOC_COLUMNS)


def reload_prepared(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "reload")
    sinks.save_dataset(preparation.prepared_rows(a.instruction_rows(spark, sf), "alpaca"), path)
    return readers.reload_saved(spark, path).select(*CONV_KEYS, "text")


def scan_prefix(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "scan-prefix")
    sinks.save_dataset(a.documents(spark, sf), path, partition_by=["source"])
    return landing.read_prefix(spark, f"{path}/source=src1").select("doc_id", "text", "source")


def land_local(spark: SparkSession, sf: str) -> DataFrame:
    """Landed twice; the second landing replaces the first."""
    path = scratch_dir(spark, "land-local")
    for _ in range(2):
        landing.land_local(spark, f"{sf}/documents.parquet", path)
    return spark.read.parquet(path).select(*DOC_COLUMNS)


def land_tree(spark: SparkSession, sf: str) -> DataFrame:
    """A directory with Parquet at the top and below partition directories, landed whole."""
    base = scratch_dir(spark, "land-tree")
    docs = a.documents(spark, sf)
    docs.filter("lang = 'en'").drop("lang").write.parquet(f"{base}/in")
    docs.filter("lang != 'en'").write.partitionBy("lang").mode("append").parquet(f"{base}/in")
    landing.land_local(spark, f"{base}/in", f"{base}/out")
    return readers.read_raw(spark, f"{base}/out").select(*DOC_COLUMNS)


def land_then_add(spark: SparkSession, sf: str) -> DataFrame:
    """A hub table landed, then a file added, twice; the rows of both are there once."""
    base = scratch_dir(spark, "land-add")
    docs = a.documents(spark, sf).select("doc_id", "text")
    sinks.save_dataset(docs, f"{base}/hub")
    landing_plan.land(spark, "huggingface", f"{base}/out", path=f"{base}/hub")
    for _ in range(2):
        landing_plan.land(spark, "local", f"{base}/out", path=f"{sf}/benchmark.parquet")
    return readers.read_raw(spark, f"{base}/out").select("doc_id", "item_id", "text")


def land_mixed_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """JSON, Parquet and CSV in one directory and below it, landed as one table."""
    base = scratch_dir(spark, "land-mixed")
    docs = a.documents(spark, sf).select("doc_id", "text")
    docs.write.json(f"{base}/in")
    a.table(spark, sf, "benchmark").write.parquet(f"{base}/in/deeper/still")
    turns = a.table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("conversation"), "role")
    turns.write.options(header=True).csv(f"{base}/in/turns")
    landing.land_local(spark, f"{base}/in", f"{base}/out")
    return readers.read_raw(spark, f"{base}/out").select("doc_id", "item_id", "conversation", "role", "text")


def land_schema_change(spark: SparkSession, sf: str) -> DataFrame:
    """Two files with different columns landed one after the other."""
    base = scratch_dir(spark, "land-schema")
    for name in ("benchmark", "labels"):
        landing.land_local(spark, f"{sf}/{name}.parquet", f"{base}/out")
    return readers.read_raw(spark, f"{base}/out").select("item_id", "text", "doc_id", "quality", "toxic")


def split_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Slices by position and percentage of splits whose files are in order of ``doc_id``."""
    path = scratch_dir(spark, "split-slice")
    split = F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train")
    docs = a.documents(spark, sf).withColumn("split", split).repartitionByRange(8, "doc_id").sortWithinPartitions("split", "doc_id")
    sinks.save_dataset(docs, path, ["split"])
    wanted = {"train[:10%]+test[5:]": "head", "train[-20:]": "tail"}
    chosen = [readers.select_split(spark, path, text).withColumn("slice", F.lit(name)) for text, name in wanted.items()]
    return chosen[0].unionByName(chosen[1]).select("doc_id", "split", "slice", "text")


def select_split(spark: SparkSession, sf: str) -> DataFrame:
    """Each split selected by its name, one after the other."""
    path = scratch_dir(spark, "split")
    split = F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train")
    sinks.save_dataset(a.documents(spark, sf).withColumn("split", split), path, ["split"])
    chosen = [readers.select_split(spark, path, name) for name in ("train", "test")]
    return chosen[0].unionByName(chosen[1]).select("doc_id", "split", "text")


def read_version(spark: SparkSession, sf: str) -> DataFrame:
    """Each version pinned by its name, one after the other."""
    path = scratch_dir(spark, "version")
    version = F.when(F.col("doc_id") % 2 == 0, "v1").otherwise("v2")
    sinks.save_dataset(a.documents(spark, sf).withColumn("version", version), path, ["version"])
    pinned = [readers.read_version(spark, path, name) for name in ("v1", "v2")]
    return pinned[0].unionByName(pinned[1]).select("doc_id", "version", "text")


# --- sinks, landing and records ------------------------------------------------


def save_prepared(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "save")
    rows = preparation.prepared_rows(a.conversations(spark, sf), "sharegpt")
    sinks.save_dataset(rows, path)
    return spark.read.parquet(path).select("conv_id", "text")


def skip_if_exists(spark: SparkSession, sf: str) -> DataFrame:
    """The second landing, of another table, does not happen."""
    path = scratch_dir(spark, "skip")
    for name in ("documents", "conversations"):
        landing_plan.land(
            spark, "local", path, path=f"{sf}/{name}.parquet", skip_if_exists=True, verify=False
        )
    return spark.read.parquet(path).select(*DOC_COLUMNS)


def verify_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as plain lines, so that the bytes follow from the table; the files are Spark's choice."""
    path = scratch_dir(spark, "verify")
    a.documents(spark, sf).select("text").write.text(path)
    return landing.landing_report(spark, path).select((F.col("num_files") > 0).alias("has_files"), "num_bytes")


def landing_counters(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "counters")
    a.documents(spark, sf).select(F.to_json(F.struct(*DOC_COLUMNS)).alias("value")).write.text(path)
    counted = landing.landing_counters(spark, path, "text")
    return counted.select((F.col("num_files") > 0).alias("has_files"), "num_bytes", "num_rows")


def prep_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Of a dataset that is saved, described and read again, with what its texts hold."""
    path = scratch_dir(spark, "manifest")
    sinks.save_dataset(preparation.prepared_rows(a.instruction_rows(spark, sf), "chatml"), path)
    sinks.save_manifest(spark, path, "conversations", "chatml")
    num_chars = readers.reload_saved(spark, path).agg(F.sum(F.length("text"))).first()[0]
    described = sinks.read_manifest(spark, path).withColumn("columns", F.array_join("columns", ","))
    return described.withColumn("num_chars", F.lit(num_chars).cast("long"))


def run_record(spark: SparkSession, sf: str) -> DataFrame:
    """A record at each run's first and last logged time; the newest per run."""
    path = scratch_dir(spark, "runs")
    spans = a.metric_log(spark, sf).groupBy(F.col("run_id").alias("run")).agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended")
    )
    for at in ("started", "ended"):
        stamped = spans.select("run", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
        sinks.run_records(stamped, {"version_tag": at}).write.mode("append").parquet(path)
    return sinks.latest_run_records(spark.read.parquet(path))


def publish_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions, then a job that breaks off and one that comes too late; each version is read as it was."""
    path = scratch_dir(spark, "published")
    docs = a.documents(spark, sf)
    published.publish(docs, path, partition_by=["lang"])
    published.publish(published.read_published(spark, path).select("doc_id", "text", F.upper("source").alias("source")), path)
    broken = docs.withColumn("source", F.when(F.col("doc_id") >= 0, F.raise_error(F.lit("broken off"))).otherwise("").cast("string"))
    for rows, after in ((broken, 2), (docs, 1)):
        try:
            published.publish(rows, path, after=after)
        except (published.ConflictError, PySparkException):
            continue
        raise RuntimeError("a job that should have failed has published")
    first, newest = published.read_published(spark, path, 1), readers.read_source(spark, "local", path)
    return first.select("doc_id", "lang", "source").join(
        newest.select("doc_id", "text", F.col("source").alias("newest_source")), "doc_id"
    )


def versioned_write(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "versions")
    sinks.save_dataset(a.documents(spark, sf), sinks.versioned_path(base, "v1.0-docs"))
    return readers.read_version(spark, base, "v1.0-docs").select("version", *DOC_COLUMNS)


# --- text rendering ------------------------------------------------------------


def fmt_alpaca(spark: SparkSession, sf: str) -> DataFrame:
    return render.render(a.instruction_rows(spark, sf), "alpaca").select(*CONV_KEYS, "text")


def fmt_alpaca_loader(spark: SparkSession, sf: str) -> DataFrame:
    rows = render.render(a.instruction_rows(spark, sf), "alpaca", variant="loader")
    return rows.select(*CONV_KEYS, "text")


def fmt_sharegpt(spark: SparkSession, sf: str) -> DataFrame:
    return render.render(a.conversations(spark, sf), "sharegpt").select("conv_id", "text")


def fmt_chatml(spark: SparkSession, sf: str) -> DataFrame:
    rows = render.render(a.instruction_rows(spark, sf), "chatml", system_msg=EXPERT)
    return rows.select(*CONV_KEYS, "text")


def fmt_llama(spark: SparkSession, sf: str) -> DataFrame:
    """The ``system`` column beats the argument."""
    rows = render.render(a.chat_rows(spark, sf), "llama", system_msg=EXPERT)
    return rows.select(*CONV_KEYS, "text")


def fmt_custom(spark: SparkSession, sf: str) -> DataFrame:
    rows = render.render(
        a.question_rows(spark, sf),
        "custom",
        instruction_col="question",
        response_col="answer",
        input_col="context",
        system_msg=EXPERT,
        strict=True,
    )
    return rows.select(*CONV_KEYS, "text")


def resolve_roles(spark: SparkSession, sf: str) -> DataFrame:
    """With both spellings present, ``instruction`` and ``output`` win."""
    rows = a.instruction_rows(spark, sf).withColumns(
        {"question": F.lit("unused"), "assistant": F.lit("unused")}
    )
    roles = formats.chat_roles(rows)
    return rows.select(*CONV_KEYS, *[value.alias(name) for name, value in roles.items()])


def prepare_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """All five formats over the same turns; the four on paired turns in one pass."""
    flat_formats = ("alpaca", "chatml", "llama", "custom")
    wide = a.instruction_rows(spark, sf)
    for name in flat_formats:
        wide = preparation.prepared_rows(wide, name).withColumnRenamed("text", name)
    texts = F.array(
        *[F.struct(F.lit(name).alias("format"), F.col(name).alias("text")) for name in flat_formats]
    )
    flat = wide.select(*CONV_KEYS, F.inline(texts))
    nested = preparation.prepared_rows(a.conversations(spark, sf), "sharegpt").select(
        "conv_id", F.lit(0).cast("long").alias("turn"), F.lit("sharegpt").alias("format"), "text"
    )
    return flat.unionByName(nested)


def autodetect_format(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared as ChatML, then rendered anew because the Alpaca columns are still there."""
    prepared = render.render(a.instruction_rows(spark, sf), "chatml")
    return detect.autodetect(prepared).select(*CONV_KEYS, "text")


def resolve_text_field(spark: SparkSession, sf: str) -> DataFrame:
    """For each table shape, the column chosen and the characters it holds."""
    shapes = {
        "documents": (a.documents(spark, sf), None),
        "documents_configured": (a.documents(spark, sf), "lang"),
        "questions_configured": (a.question_rows(spark, sf), "answer"),
        "questions_first_string": (a.question_rows(spark, sf), None),
    }
    result = None
    for shape, (df, configured) in shapes.items():
        field = detect.resolve_text_field(df, configured, first_string=True)
        part = df.agg(F.sum(F.length(field)).alias("num_chars")).select(
            F.lit(shape).alias("shape"), F.lit(field).alias("text_field"), "num_chars"
        )
        result = part if result is None else result.unionByName(part)
    return result


def train_projection(spark: SparkSession, sf: str) -> DataFrame:
    return detect.training_projection(a.documents(spark, sf))


# --- filters, limits, counts -----------------------------------------------------


def _context_as_text(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose text is blank wherever the conversation has no system turn."""
    return a.instruction_rows(spark, sf).withColumn("text", F.col("input"))


def filter_empty(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_empty(_context_as_text(spark, sf)).select(*CONV_KEYS, "text")


def filter_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.filter_report(_context_as_text(spark, sf))


def blank_predicate(spark: SparkSession, sf: str) -> DataFrame:
    return a.instruction_rows(spark, sf).select(*CONV_KEYS, blank(F.col("input")).alias("is_blank"))


def filter_roles(spark: SparkSession, sf: str) -> DataFrame:
    """System turns renamed to a role that is not rendered."""
    turns = a.table(spark, sf, "conversations").withColumn(
        "role", F.when(F.col("role") == "system", "tool").otherwise(F.col("role"))
    )
    nested = a.assemble_conversations(turns)
    return nested.select(
        "conv_id",
        F.size("conversations").cast("long").alias("num_messages"),
        F.size(formats.kept_messages(nested)).cast("long").alias("num_kept"),
        F.array_join(F.transform(formats.kept_messages(nested), lambda m: m["value"]), "\n").alias("kept"),
    )


def first_n(spark: SparkSession, sf: str) -> DataFrame:
    return quality.first_n(a.documents(spark, sf), 100).select("doc_id", "text")


def first_n_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Of the documents of one language of the longer half, by the files' order."""
    longer = a.documents(spark, sf).filter("lang = 'en' AND n_chars > 1000")
    return quality.first_n(longer, 60).select("doc_id", "text")


def first_n_half(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the table by a key of three columns, by counting ranges until no more than 20 rows are left."""
    docs = a.documents(spark, sf)
    at = [F.col(c).alias(c) for c in ("lang", "n_chars", "doc_id")]
    last = selection.nth_smallest(docs, (docs.count() + 1) // 2, at, few=20)
    return docs.filter(F.struct(*at) <= last).select("doc_id", "lang", "n_chars")


def first_n_ties(spark: SparkSession, sf: str) -> DataFrame:
    """By a key that many rows share; the file is in order of ``doc_id``, which so breaks ties."""
    return quality.first_n(a.documents(spark, sf), 70, "lang").select("doc_id", "lang", "text")


def first_n_json(spark: SparkSession, sf: str) -> DataFrame:
    """All even documents as JSON lines, then seven of the odd ones, which come as JSON arrays."""
    base = scratch_dir(spark, "first-json")
    docs = a.documents(spark, sf).select("doc_id", "text")
    even = docs.filter("doc_id % 2 = 0")
    even.write.json(f"{base}/a-lines")
    (
        docs.filter("doc_id % 2 = 1")
        .groupBy(F.floor(F.col("doc_id") / 250).alias("chunk"))
        .agg(F.to_json(F.array_sort(F.collect_list(F.struct("doc_id", "text")))).alias("value"))
        .write.partitionBy("chunk")
        .text(f"{base}/b-arrays")
    )
    arrays = [e.path for e in files.files_below(spark, files.list_dir(spark, f"{base}/b-arrays")) if e.name.endswith(".txt")]
    places = ("file", "part", "nth")
    mixed = readers.read_json(spark, [f"{base}/a-lines", *arrays], places=places)
    return quality.first_n_placed(mixed, even.count() + 7, places).select("doc_id", "text")


def preview(spark: SparkSession, sf: str) -> DataFrame:
    return quality.preview(a.documents(spark, sf))


def count_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.count_rows(a.documents(spark, sf))


# --- user functions --------------------------------------------------------------


def udf_format(spark: SparkSession, sf: str) -> DataFrame:
    def question_and_answer(row):
        return {"text": f"Q: {row['instruction']}\nA: {row['output']}"}

    rows = render.map_rows(
        a.instruction_rows(spark, sf), question_and_answer, columns=["instruction", "output"]
    )
    return rows.select(*CONV_KEYS, "text")


def udf_map_nested(spark: SparkSession, sf: str) -> DataFrame:
    """A row function that returns a list and a nested value."""

    def lines(row):
        parts = row["text"].split("\n")
        return {"lines": parts, "shape": {"count": len(parts), "longest": max(map(len, parts))}}

    rows = render.map_rows(
        a.documents(spark, sf), lines, {"lines": "array<string>", "shape": "struct<count: int, longest: long>"}, ["text"]
    )
    return rows.select(
        "doc_id",
        F.array_join("lines", "|").alias("joined"),
        F.col("shape.count").cast("long").alias("num_lines"),
        F.col("shape.longest").alias("longest"),
    )


def udf_filter(spark: SparkSession, sf: str) -> DataFrame:
    def has_context(row):
        return len(row["input"].strip()) > 0

    rows = render.filter_rows(a.instruction_rows(spark, sf), has_context, columns=["input"])
    return rows.select(*CONV_KEYS, "input")


# --- what the trainer, the viewer and the init step do ------------------------------


def assemble_conversations(spark: SparkSession, sf: str) -> DataFrame:
    line = lambda m: F.concat(m["from"], F.lit(": "), m["value"])
    return a.conversations(spark, sf).select(
        "conv_id",
        F.size("conversations").cast("long").alias("num_messages"),
        F.array_join(F.transform("conversations", line), "\n").alias("messages"),
    )


def token_cap(spark: SparkSession, sf: str) -> DataFrame:
    capped = lengths.token_cap(a.documents(spark, sf).select("doc_id", "text"), 512)
    return capped.select(
        "doc_id", "n_tokens", "truncated", F.array_join("tokens", " ").alias("capped_tokens")
    )


def pair_turns(spark: SparkSession, sf: str) -> DataFrame:
    """With gaps: turn numbers are spread out."""
    spread = a.table(spark, sf, "conversations").withColumn("turn", F.col("turn") * 700 + F.col("conv_id") % 5)
    return turns.pair_turns(spread)


def length_report(spark: SparkSession, sf: str) -> DataFrame:
    report = lengths.length_report(a.documents(spark, sf), ["source", "lang"], 512)
    return report.withColumn("mean_tokens", F.round("mean_tokens", 6))


def length_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Of a count of one's own, the characters of all turns."""
    told = lengths.length_report(
        a.table(spark, sf, "conversations"), percentiles=(1, 25, 50, 95, 100), n_tokens=F.length("text")
    )
    return told.select("num_rows", *[f"p{k}_tokens" for k in (1, 25, 50, 95, 100)])


def seeded_order(spark: SparkSession, sf: str) -> DataFrame:
    return order.seeded_order(a.documents(spark, sf), "doc_id", seed=42)


def seeded_order_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """By a key that thousands of rows repeat, numbered in cells of 100: each key's rows stand together, none shares a place."""
    rows = order.seeded_order(a.documents(spark, sf), "lang", seed=42, most=100)
    return rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.countDistinct("position").alias("num_places"),
        F.min("position").alias("first"),
        F.max("position").alias("last"),
        F.sum("doc_id").alias("ids"),
    )


def shard_ranks(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "shards")
    rows = order.seeded_order(a.documents(spark, sf).select("doc_id", "text"), "doc_id", seed=42)
    order.export_shards(rows, path, world_size=4)
    return spark.read.parquet(path).select("doc_id", "position", F.col("rank").cast("long").alias("rank"))


def batch_assign(spark: SparkSession, sf: str) -> DataFrame:
    return order.assign_batches(
        seeded_order(spark, sf), world_size=4, per_device_batch=2, accumulation=4
    )


def epoch_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Two epochs and a half, each in an order of its own."""
    ordered = order.seeded_order(a.documents(spark, sf).select("doc_id"), "doc_id", seed=42)
    return order.epoch_batches(ordered, epochs=2.5, world_size=4, per_device_batch=2, accumulation=4)


def epoch_batches_max_steps(spark: SparkSession, sf: str) -> DataFrame:
    """As many epochs as the steps take; what each rank sees in each step."""
    turns_ = a.table(spark, sf, "conversations").select("conv_id", "turn")
    ordered = order.seeded_order(turns_, ["conv_id", "turn"], seed=7)
    dealt = order.epoch_batches(ordered, max_steps=100, world_size=2, per_device_batch=4, accumulation=1, seed=7)
    return dealt.groupBy("rank", "step").agg(
        F.count(F.lit(1)).alias("num_rows"), F.min("epoch_position").alias("first"), F.sum(F.col("conv_id") * (F.col("turn") + 1)).alias("mark")
    )


def resume_from_step(spark: SparkSession, sf: str) -> DataFrame:
    """Steps 5 to 19 of shards for three ranks, each row with the step it is seen in."""
    path = scratch_dir(spark, "resume")
    ordered = order.seeded_order(a.documents(spark, sf).select("doc_id", "text"), "doc_id", seed=42)
    order.export_shards(ordered, path, world_size=3, rows_per_file=20)
    shards.save_index(spark, path)
    left = shards.read_from_step(spark, path, 5, world_size=3, per_device_batch=2, accumulation=1, stop=20)
    seen = order.assign_batches(left.drop("rank"), world_size=3, per_device_batch=2, accumulation=1)
    return seen.select("doc_id", "text", "position", "rank", "step")


def step_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Under three settings of batch, accumulation and steps."""
    docs = a.documents(spark, sf)
    plans = {
        "demo": dict(world_size=4, per_device_batch=2, accumulation=4),
        "production": dict(world_size=8, per_device_batch=8, accumulation=2, epochs=3),
        "production_override": dict(world_size=8, per_device_batch=4, accumulation=8, epochs=3),
        "dry_run": dict(world_size=4, per_device_batch=2, accumulation=4, dry_run=True),
    }
    return order.step_plans(docs, plans)


def retain_last_k(spark: SparkSession, sf: str) -> DataFrame:
    rows = a.documents(spark, sf).select("source", "doc_id")
    return retention.retain_last_k(rows, "source", "doc_id", k=3)


def metric_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.metric_rollup(a.metric_log(spark, sf), "1 hour"))


def incremental_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Three lots of files, each with rows of all times, folded in one after the other; then nothing new."""
    base = scratch_dir(spark, "rollup")
    events = a.table(spark, sf, "events")
    for lot in range(3):
        events.filter(F.col("event_id") % 3 == lot).write.parquet(f"{base}/in/lot={lot}")
        for new in (True, False):
            folded = rollup.fold_new_files(spark, f"{base}/in", f"{base}/state", events.schema, as_log=a.as_metric_log)
            if (folded > 0) != new:
                raise RuntimeError(f"{folded} new files in lot {lot}")
    return _rounded(rollup.rolled_up(spark, f"{base}/state"))


def latest_metric(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latest_metrics(a.metric_log(spark, sf), METRIC_TAGS)


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Run twice over the same files; the second run adds nothing."""
    base = scratch_dir(spark, "stream-ingest")
    schema = a.documents(spark, sf).schema
    for _ in range(2):
        jobs.ingest_new_files(
            spark,
            f"{sf}/documents.parquet",
            f"{base}/rows",
            f"{base}/checkpoint",
            schema,
            "custom",
            instruction_col="source",
            response_col="text",
        )
    return spark.read.parquet(f"{base}/rows").select("doc_id", "text")


def stream_then_train(spark: SparkSession, sf: str) -> DataFrame:
    """What a stream wrote, loaded for training; a file the stream never committed is not read."""
    base = scratch_dir(spark, "stream-train")
    docs = a.documents(spark, sf)
    options = dict(instruction_col="source", response_col="text")
    jobs.ingest_new_files(
        spark, f"{sf}/documents.parquet", f"{base}/rows", f"{base}/checkpoint", docs.schema, "custom", **options
    )
    docs.limit(5).withColumn("text", F.lit("left over")).write.mode("append").parquet(f"{base}/rows")
    return training.training_rows(spark, "local", f"{base}/rows", key="doc_id", seed=42)


def stream_prepare(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "stream-prepare")
    nested = a.conversations(spark, sf)
    nested.write.parquet(f"{base}/in")
    arriving = jobs.file_stream(spark, f"{base}/in", nested.schema)
    jobs.append_available(jobs.prepare_stream(arriving, "sharegpt"), f"{base}/rows", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/rows").select("conv_id", "text")


def _streamed(spark: SparkSession, sf: str, base: str) -> DataFrame:
    """Conversations closed by a stream that gets their turns from four files, run again half-way."""
    turns_ = a.table(spark, sf, "conversations").withColumn("said", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("turn") * 60))
    for lot in range(4):
        part = turns_.filter(F.col("turn") % 4 == lot)
        if lot == 3:
            end = F.timestamp_seconds(F.lit(1_800_000_000)).alias("said")
            part = part.union(spark.range(1).select(F.lit(-1).cast("long"), F.lit(0).cast("long"), F.lit(""), F.lit(""), end))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        if lot in (1, 3):
            arriving = jobs.file_stream(spark, f"{base}/in", turns_.schema, max_files_per_trigger=1)
            with conversations.keyed_state(spark):
                jobs.append_available(conversations.assemble_stream(arriving, "said", delay="1 day"), f"{base}/rows", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/rows")


def stream_assemble(spark: SparkSession, sf: str) -> DataFrame:
    closed = conversations.conversations_of(_streamed(spark, sf, scratch_dir(spark, "stream-assemble")))
    line = lambda m: F.concat(m["from"], F.lit(": "), m["value"])
    return closed.select(
        "conv_id",
        F.size("conversations").cast("long").alias("num_messages"),
        F.array_join(F.transform("conversations", line), "\n").alias("messages"),
    )


def stream_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.pairs_of(_streamed(spark, sf, scratch_dir(spark, "stream-pairs")))


def stream_metric_rollup(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "stream-metrics")
    events = jobs.file_stream(spark, f"{sf}/events.parquet", a.table(spark, sf, "events").schema)
    windows = jobs.metric_rollup_stream(a.as_metric_log(events), every="1 hour", delay="10 minutes")
    jobs.append_available(windows, f"{base}/rows", f"{base}/checkpoint")
    done = spark.read.parquet(f"{base}/rows")
    return _rounded(
        done.withColumns(
            {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
        )
    )


def _rounded(windows: DataFrame) -> DataFrame:
    """Means of floats depend on the order of addition in their last digits."""
    return windows.withColumn("mean_value", F.round("mean_value", 9))


QUERIES = {
    f.__name__: f
    for f in (
        scan_source,
        scan_json,
        scan_json_array,
        scan_parquet,
        scan_csv,
        scan_dir_priority,
        reload_prepared,
        scan_prefix,
        land_local,
        land_tree,
        land_then_add,
        land_mixed_kinds,
        land_schema_change,
        select_split,
        split_slice,
        read_version,
        save_prepared,
        skip_if_exists,
        verify_landing,
        prep_manifest,
        run_record,
        publish_versions,
        versioned_write,
        landing_counters,
        fmt_alpaca,
        fmt_alpaca_loader,
        fmt_sharegpt,
        fmt_chatml,
        fmt_llama,
        fmt_custom,
        resolve_roles,
        prepare_dispatch,
        autodetect_format,
        resolve_text_field,
        train_projection,
        filter_empty,
        filter_report,
        blank_predicate,
        filter_roles,
        first_n,
        first_n_filtered,
        first_n_ties,
        first_n_json,
        first_n_half,
        preview,
        count_rows,
        udf_format,
        udf_map_nested,
        udf_filter,
        assemble_conversations,
        pair_turns,
        token_cap,
        length_report,
        length_percentiles,
        seeded_order,
        seeded_order_hot_keys,
        shard_ranks,
        batch_assign,
        epoch_batches,
        epoch_batches_max_steps,
        resume_from_step,
        step_plan,
        retain_last_k,
        stream_ingest,
        stream_then_train,
        stream_prepare,
        metric_rollup,
        incremental_rollup,
        stream_metric_rollup,
        stream_assemble,
        stream_pairs,
        latest_metric,
    )
}
