"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a shuffled but fixed order, again and
again up to ``max_repeats`` times. A copy's virtual finish time is the source's
tokens up to and including it, divided by the source's weight. All copies are
put in the order of their finish times and the mix takes them until the next
one would exceed the budget. A source whose queue ends early thus leaves its
share to the others, in proportion to their weights.

Only DataFrame functions are used. Sums along a source and along the whole
queue are taken in two levels: sums of slices, then sums within a slice. Slices
hold about ``rows_per_slice`` rows however large the table or one source is, as
they cut a uniform hash (documents) or the virtual time (copies).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.common import WORD, fresh, written

_HASH_RANGE = float(16**15)


def word_count(text: str):
    """Runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_repeats: int) -> DataFrame:
    """Per source: ``sid``, ``rank``, ``weight``, ``source_size``, ``target``, ``level``, ``budget``.

    Sources stand in the order of their names' code points, null last, and take
    the weights in turn. ``level`` is the virtual time at which the budget is
    spent: sources that reach ``max_repeats`` times their size before it stop
    there, and the rest share what is left by weight.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_end = Window.orderBy("ends", "rank")
    left = F.col("budget") - F.coalesce(F.sum("cap").over(by_end.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sharing = F.sum("weight").over(by_end.rowsBetween(0, Window.unboundedFollowing))
    return (
        sizes.groupBy("sid", "source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.lit(list(weights)), F.col("rank") % len(weights) + 1).cast("long"))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("ends", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", left / sharing)
        .withColumn("level", F.when(F.col("level") <= F.col("ends"), F.col("level")))
        .withColumn("level", F.coalesce(F.max("level").over(everything), F.max("ends").over(everything)))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
        .select("sid", "rank", "weight", "source_size", "target", "level", "budget")
    )


def fair_queue(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_repeats: int = 2,
    rows_per_slice: int = 2_500,
    seed: str = "",
) -> DataFrame:
    """How often the mix takes each document.

    Returns one row per input row: ``key``, ``source``, ``size`` (words of the
    text), ``source_size``, ``target`` (double) and ``copies`` (0 to
    ``max_repeats``). The budget is ``share`` times all sizes.

    A null text has size 0, a null source is a source of its own, the last in
    order. Documents of size 0 are never taken. Equal rows are taken one after
    the other like any others, so one of them may be taken once more. Reruns agree: the order
    depends on the key, the size and ``seed`` alone. An empty table gives no rows.
    """
    sizes = written(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            word_count(text).alias("size"),
        ).withColumns(
            {
                "sid": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
                "hash": F.conv(
                    F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("key").cast("string"), F.lit("")))), 1, 15), 16, 10
                ).cast("long"),
            }
        ),
        "mix-sizes",
    )
    slices = max(1, math.ceil(sizes.count() / rows_per_slice))
    sliced = sizes.withColumn("slice", F.floor(F.col("hash") / _HASH_RANGE * slices))
    targets = written(source_targets(sizes, weights, share, max_repeats), "mix-targets")

    # The queues: tokens of the source up to each document, by slices of the hash.
    earlier = Window.partitionBy("sid").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("sid", "slice")
        .agg(F.sum("size").alias("slice_size"))
        .withColumn("before", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
        .join(targets, "sid")
    )
    within = Window.partitionBy("sid", "slice").orderBy("hash", "key", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = written(
        sliced.join(offsets, ["sid", "slice"])
        .withColumn("done", F.col("before") + F.sum("size").over(within))
        .select("key", "source", "size", "hash", "rank", "weight", "source_size", "target", "level", "budget", "done"),
        "mix-queue",
    )

    # All copies in the order of finish, by slices of the virtual time up to the end of the budget.
    finish = lambda n: (F.col("source_size") * n + F.col("done")).cast("double") / F.col("weight")
    place = lambda n: F.struct(
        finish(n).alias("finish"), F.col("rank"), F.col("hash"), F.col("key"), F.lit(n).alias("pass")
    )
    at = lambda f: F.when(F.col("level") > 0, F.floor(f / F.col("level") * slices)).otherwise(F.lit(0))
    copies = queued.filter("size > 0").select(
        "size", "level", "budget", F.explode(F.array(*[place(n) for n in range(max_repeats)])).alias("place")
    ).withColumn("slot", at(F.col("place.finish")))
    before = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        copies.groupBy("slot")
        .agg(F.sum("size").alias("slot_size"), F.first("budget").alias("budget"))
        .withColumn("before", F.coalesce(F.sum("slot_size").over(before), F.lit(0)))
        .filter("before <= budget")
        .agg(F.max(F.struct("slot", "before")).alias("last"))
        .select("last.*")
        .first()
    )
    if last is None or last["slot"] is None:
        taken = F.lit(0)
    else:
        upto = Window.partitionBy("slot").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        cut = written(
            copies.filter(F.col("slot") == last["slot"])
            .withColumn("total", F.sum("size").over(upto) + last["before"])
            .filter("total <= budget")
            .groupBy()
            .agg(F.max("place").alias("cut")),
            "mix-cut",
        ).first()["cut"]
        taken = sum((_taken(at(finish(n)), place(n), last["slot"], cut) for n in range(max_repeats)), F.lit(0))
    return queued.select(
        F.col("key").alias(key),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, taken).otherwise(0).cast("int").alias("copies"),
    )


def _taken(slot, place, last_slot, cut):
    """1 if a copy stands before the end of the mix, else 0."""
    in_last = F.lit(False)
    if cut is not None:
        in_last = (slot == last_slot) & (place <= F.struct(*[F.lit(v).alias(k) for k, v in cut.asDict().items()]))
    return F.when((slot < last_slot) | in_last, 1).otherwise(0)


def mix(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The mixed table: each document as often as the queue takes it, in no order, its columns unchanged.

    ``key`` must name documents apart; rows that share it are taken together,
    as often as the most taken of them.
    """
    plan = fair_queue(docs, key, **options).filter("copies > 0").groupBy(key).agg(F.max("copies").alias("copies"))
    columns = docs.columns
    plan = plan.select(F.col(key).alias("mix_key"), F.array_repeat(F.lit(1), F.col("copies")).alias("mix_copies"))
    left, right = docs.alias("d"), plan.alias("m")
    joined = left.join(right, F.col(f"d.`{key}`").eqNullSafe(F.col("m.mix_key")))
    copy = fresh(docs, "copy")
    return joined.select(*[F.col(f"d.`{c}`") for c in columns], F.explode("m.mix_copies").alias(copy)).drop(copy)
