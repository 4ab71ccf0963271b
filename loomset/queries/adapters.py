"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.operators.turns import assemble_conversations, pair_turns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation: ``conv_id``, ``conversations``."""
    return assemble_conversations(table(spark, sf_dir, "conversations"))


def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns answered by the next turn, as Alpaca rows; ``input`` is the system text, or empty."""
    return pair_turns(table(spark, sf_dir, "conversations"))


def chat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns ``system``, ``user``, ``assistant``."""
    return instruction_rows(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.col("input").alias("system"),
        F.col("instruction").alias("user"),
        F.col("output").alias("assistant"),
    )


def question_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns ``question``, ``answer``, ``context``."""
    return instruction_rows(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.col("instruction").alias("question"),
        F.col("output").alias("answer"),
        F.col("input").alias("context"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a metric log: ``run_id``, ``step``, ``ts``, ``tag``, ``value``."""
    return as_metric_log(table(spark, sf_dir, "events"))


def as_metric_log(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("step"),
        "ts",
        F.col("event_type").alias("tag"),
        "value",
    )
