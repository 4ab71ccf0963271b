"""Saved datasets, their manifests, run records and versioned paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions.text import ref
from loomset.sources import files

# Underscored, so that no reader takes it for data.
MANIFEST_DIR = "_preparation_metadata"

# Fields of a run record with their defaults.
RUN_FIELDS: dict[str, tuple[str, Any]] = {
    "timestamp": ("string", None),
    "model_name": ("string", "meta-llama/Llama-3.2-3B-Instruct"),
    "model_revision": ("string", "main"),
    "version_tag": ("string", None),
    "dataset_source": ("string", "huggingface"),
    "dataset_name": ("string", "tatsu-lab/alpaca"),
    "quantization": ("string", "4bit"),
    "lora_r": ("long", 16),
    "lora_alpha": ("long", 32),
    "max_seq_length": ("long", 512),
    "num_train_epochs": ("double", 1.0),
    "learning_rate": ("double", 2e-4),
    "per_device_train_batch_size": ("long", 2),
    "gradient_accumulation_steps": ("long", 4),
    "world_size": ("long", 1),
    "cuda_devices": ("long", 0),
    "torch_version": ("string", None),
}


def save_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, replacing whatever the target held, all of its partitions included."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def manifest(df: DataFrame, source: str, format: str) -> DataFrame:
    """One row: source, format, number of rows and column names."""
    return df.agg(F.count(F.lit(1)).alias("num_samples")).select(
        F.lit(source).alias("source"),
        F.lit(format).alias("format"),
        "num_samples",
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
    )


def save_manifest(spark: SparkSession, path: str, source: str, format: str) -> None:
    """Describe a saved dataset, counting what was written (Parquet footers only)."""
    saved = spark.read.parquet(files.escape_glob(path))
    manifest(saved, source, format).write.mode("overwrite").json(f"{path.rstrip('/')}/{MANIFEST_DIR}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "source string, format string, num_samples long, columns array<string>"
    ).json(files.escape_glob(f"{path.rstrip('/')}/{MANIFEST_DIR}"))


def run_record_schema() -> T.StructType:
    return T.StructType.fromDDL(
        "run string, " + ", ".join(f"`{name}` {dtype}" for name, (dtype, _) in RUN_FIELDS.items())
    )


def run_records(runs: DataFrame, settings: Mapping[str, Any] | None = None) -> DataFrame:
    """A record per row of ``runs`` (columns ``run`` and any of the fields).

    Fields the table lacks come from ``settings``, else from the defaults.
    """
    settings = settings or {}
    unknown = set(settings) - set(RUN_FIELDS)
    if unknown:
        raise ValueError(f"unknown run fields: {sorted(unknown)}")
    fields = []
    for name, (dtype, default) in RUN_FIELDS.items():
        value = ref(name) if name in runs.columns else F.lit(settings.get(name, default))
        fields.append(value.cast(dtype).alias(name))
    return runs.select(ref("run").cast("string").alias("run"), *fields)


def save_run_record(
    spark: SparkSession, path: str, run: str, settings: Mapping[str, Any] | None = None
) -> None:
    """Append one record, stamped now; call before and again after a run."""
    stamped = {**(settings or {}), "timestamp": datetime.now().isoformat()}
    one = spark.range(1).select(F.lit(run).alias("run"))
    run_records(one, stamped).write.mode("append").parquet(path)


def latest_run_records(records: DataFrame) -> DataFrame:
    """Each run's newest record."""
    whole = F.struct(*[ref(name) for name in RUN_FIELDS])
    newest = records.groupBy("run").agg(F.max_by(whole, ref("timestamp")).alias("_record"))
    return newest.select("run", "_record.*")


def versioned_path(
    output_dir: str, tag: str | None = None, enabled: bool = True, now: datetime | None = None
) -> str:
    """``<dir>/<tag>``, or ``<dir>/run_<time>`` without a tag, or the directory itself.

    Call once per job on the driver and pass the result on, so that every
    writer uses the same time.
    """
    if not enabled:
        return output_dir
    name = tag or (now or datetime.now()).strftime("run_%Y%m%d_%H%M%S")
    return f"{output_dir.rstrip('/')}/{name}"
