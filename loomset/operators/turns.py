"""Turn tables into one row per conversation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomset.functions.text import ref

# Message field <- turn column.
SHAREGPT_FIELDS = {"from": "role", "value": "text"}


def assemble_conversations(
    turns: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    fields: Mapping[str, str] | None = None,
    block: int | None = 1024,
) -> DataFrame:
    """One ``conversations`` array per key, messages in turn order.

    Turns are first gathered per (key, run of ``block`` turn numbers) and then
    the runs per key, so that a conversation with a large share of all turns is
    collected and sorted by many tasks and the last one only strings ready runs
    together. With ``block=None`` one aggregation gathers them, for tables whose conversations are known to be short.
    """
    fields = fields or SHAREGPT_FIELDS
    message = F.struct(ref(order).alias("_at"), *[ref(src).alias(name) for name, src in fields.items()])
    gathered = F.sort_array(F.collect_list(message))
    if block is None:
        in_order = turns.groupBy(ref(key)).agg(gathered.alias("_messages"))
    else:
        run = F.call_function("div", ref(order), F.lit(block))
        runs = turns.groupBy(ref(key), run.alias("_run")).agg(gathered.alias("_messages"))
        in_order = (
            runs.groupBy(ref(key))
            .agg(F.sort_array(F.collect_list(F.struct("_run", "_messages"))).alias("_runs"))
            .select(ref(key), F.flatten(F.transform("_runs", lambda r: r["_messages"])).alias("_messages"))
        )
    messages = F.transform("_messages", lambda m: F.struct(*[m[name].alias(name) for name in fields]))
    return in_order.select(ref(key), messages.alias("conversations"))


def pair_turns(
    turns: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    asks: str = "user",
    answers: str = "assistant",
    context: str = "system",
    block: int = 1024,
) -> DataFrame:
    """Question and answer rows: ``key``, ``order``, ``instruction``, ``input``, ``output``.

    A turn of role ``asks`` is paired with the turn that follows it, whatever
    number that has, if its role is ``answers``; ``input`` is the first text of
    role ``context`` in the conversation, or empty. Turn numbers are unique within a
    conversation; turns without a number stand first.

    The next turn is looked up within runs of ``block`` turn numbers, and for
    the last turn of a run among the first turns of later runs. So a
    conversation with a large share of all turns is paired by many tasks.
    """
    said = F.struct(ref(role).alias("role"), ref(text).alias("text"))
    rows = turns.select(
        ref(key).alias("key"),
        ref(order).alias("at"),
        said.alias("said"),
        F.call_function("div", ref(order), F.lit(block)).alias("run"),
    )
    within = Window.partitionBy("key", "run").orderBy("at")
    of_key = Window.partitionBy("key").orderBy("run")
    firsts = (
        rows.groupBy("key", "run")
        .agg(F.min_by("said", "at").alias("first_said"), F.first("said").alias("any_said"))
        # min_by passes over a missing number; such a run is a turn of its own.
        .select("key", "run", F.lead(F.coalesce("first_said", "any_said")).over(of_key).alias("later"))
        .filter(F.col("later").isNotNull())
    )
    here = rows.withColumn("next", F.lead("said").over(within)).filter(F.col("said.role") == asks)
    same_run = here["key"].eqNullSafe(firsts["key"]) & here["run"].eqNullSafe(firsts["run"])
    answered = (
        here.join(firsts, same_run, "left")
        .select(here["key"], "at", "said", F.coalesce("next", "later").alias("answer"))
        .filter(F.col("answer.role") == answers)
    )
    contexts = (
        rows.filter(F.col("said.role") == context).groupBy("key").agg(F.min_by("said.text", "at").alias("context"))
    )
    joined = answered.join(contexts, answered["key"].eqNullSafe(contexts["key"]), "left")
    return joined.select(
        answered["key"].alias(key),
        F.col("at").alias(order),
        F.col("said.text").alias("instruction"),
        F.coalesce("context", F.lit("")).alias("input"),
        F.col("answer.text").alias("output"),
    )
