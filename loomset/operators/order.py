"""Seeded global order, and the ranks, batches and steps that follow from it."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.functions.text import fresh, ref
from loomset.session import scratch_dir

# Fixed value: length of a dry run.
DRY_RUN_STEPS = 5

# Rows of one key that one task numbers.
MOST_PER_TASK = 250_000

# One small row per slice is broadcast; this many take some tens of megabytes.
MAX_SLICES = 1_000_000


def _shuffle_hash(keys: list[str], seed: int) -> Column:
    parts = [F.coalesce(ref(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws("\x1f", *parts)))


def _div(dividend: Column, divisor: int) -> Column:
    return F.call_function("div", dividend, F.lit(divisor).cast("long"))


def seeded_order(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int = 42,
    slices: int | None = None,
    column: str = "position",
    unique: bool = False,
    most: int = MOST_PER_TASK,
) -> DataFrame:
    """A permutation fixed by the seed, as a dense position from 0.

    Rows are ordered by a hash of seed and key. Hashes are uniform, so equal
    ranges of them are evenly filled slices, known without sampling: each row
    moves once, straight to the task of its slice, is numbered there, and moved
    up by the rows of earlier slices. Those offsets are one row per slice,
    whatever the data's size; they come from a count over the key columns alone
    and are broadcast. Task after task holds consecutive positions. Every step
    is a pure function of the rows, so a lost task can be run again.

    ``slices`` defaults to the session's shuffle partitions. Rows that repeat a
    key stand together in the order of a hash of all their columns (but for
    maps), which only equal rows share. Where a key has more than ``most`` rows,
    its rows are sliced once more, by that hash, and if as many are equal they become
    one row with a count until their places are dealt out; so many tasks
    number them (equal rows that differ in maps only are left to one). A count per slice, one more pass over
    the key columns, says whether there is such a key; ``unique`` spares it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    _positive(slices=slices)
    if slices > MAX_SLICES:
        raise ValueError(f"slices must be at most {MAX_SLICES}, got {slices}")
    hashed = _shuffle_hash(keys, seed)
    if not unique:
        held = df.groupBy(_slice_of(hashed, slices).alias("slice")).agg(F.count(F.lit(1)).alias("held"))
        if not held.filter(F.col("held") > most).isEmpty():
            return _order_in_cells(df, keys, hashed, slices, column, most)

    names = {name: fresh(df, name) for name in ("hash", "content", "slice", "nth", "held", "offset")}
    by_slice = Window.orderBy(names["slice"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.col(names["held"])
    offsets = (
        df.groupBy(_slice_of(hashed, slices).alias(names["slice"]))
        .agg(F.count(F.lit(1)).alias(names["held"]))
        .select(names["slice"], (F.sum(held).over(by_slice) - held).alias(names["offset"]))
    )

    within = Window.partitionBy(names["slice"]).orderBy(
        names["hash"], *[ref(k) for k in keys], names["content"]
    )
    numbered = (
        df.withColumn(names["hash"], hashed)
        .withColumn(names["slice"], _slice_of(F.col(names["hash"]), slices))
        .repartitionById(slices, names["slice"])
        .withColumn(names["content"], _content_hash(df))
        .withColumn(names["nth"], F.row_number().over(within))
    )
    # Every slice has its offset; a left join spares a null test on the hash.
    placed = numbered.join(F.broadcast(offsets), names["slice"], "left")
    position = F.col(names["offset"]) + F.col(names["nth"]) - 1
    return placed.select(*[ref(c) for c in df.columns if c != column], position.alias(column))


def _order_in_cells(df: DataFrame, keys: list[str], hashed: Column, slices: int, column: str, most: int) -> DataFrame:
    """``seeded_order`` where slices hold keys of more than ``most`` rows.

    Such keys cut their slice into segments: rows before them, their own, rows
    after. Their own are cut by equal ranges of the content's hash, and those by contents that
    more than ``most`` rows share. These cells follow each other in the order of the rows, so sums of
    their counts are the offsets. Keys and contents of that many rows are few: fewer than rows / ``most``.
    """
    n = {
        name: fresh(df, name)
        for name in ("hash", "content", "slice", "heavy", "segment", "part", "piece", "own", "id", "offset", "at", "copies", "nth", "held", "ids")
    }
    c = {name: F.col(full) for name, full in n.items()}
    cell = [n["slice"], n["segment"], n["part"], n["piece"]]
    marked = df.withColumns({n["hash"]: hashed, n["slice"]: _slice_of(hashed, slices), n["content"]: _content_hash(df)})
    marks = marked.select(*[c[name].alias(name) for name in ("hash", "slice", "content")])
    count = F.count(F.lit(1))

    full = marks.groupBy("slice").agg(count.alias("rows")).filter(F.col("rows") > most).select("slice")
    in_full = marks.join(F.broadcast(full), "slice", "left_semi")
    hot = _kept(in_full.groupBy("slice", "hash").agg(count.alias("rows")).filter(F.col("rows") > most), "hot-keys")
    of_hot = marks.join(F.broadcast(hot.select("hash")), "hash", "left_semi")
    equal = of_hot.groupBy("hash", "content").agg(count.alias("rows")).filter(F.col("rows") > most)
    if _plain(df) != df.columns:
        equal = equal.limit(0)
    contents = _kept(equal, "hot-contents").groupBy("hash").agg(F.array_sort(F.collect_list("content")).alias("contents"))
    parts = F.ceil(F.col("rows") / most).alias("parts")
    heavy = hot.join(contents, "hash", "left").select("slice", "hash", parts, F.coalesce("contents", F.array().cast("array<bigint>")).alias("contents"))
    by_slice = heavy.groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("hash", "parts", "contents"))).alias(n["heavy"]))

    # The cell of each row; those of other slices have null for the list and are one cell.
    own = F.get(F.filter(c["heavy"], lambda h: h["hash"] == c["hash"]), F.lit(0))
    before = F.size(F.filter(c["heavy"], lambda h: h["hash"] < c["hash"]))
    unsigned = F.shiftright(c["content"], 32) + F.lit(1 << 31)
    in_cells = (
        marked.join(F.broadcast(by_slice.withColumnRenamed("slice", n["slice"])), n["slice"], "left")
        .withColumn(n["own"], own)
        .withColumn(n["segment"], F.when(c["heavy"].isNull(), 0).otherwise(2 * before + c["own"].isNotNull().cast("int")))
        .withColumn(n["part"], F.coalesce(F.shiftright(unsigned * c["own"]["parts"], 32), F.lit(0)))
        .withColumn(
            n["piece"],
            F.when(c["own"].isNull(), 0).otherwise(
                2 * F.size(F.filter(c["own"]["contents"], lambda v: v < c["content"])) + F.array_contains(c["own"]["contents"], c["content"]).cast("int")
            ),
        )
        .drop(n["heavy"], n["own"])
    )
    in_order = Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    ids = F.when(c["piece"] % 2 == 1, F.ceil(c["held"] / most)).otherwise(F.lit(1).cast("long"))
    cells = _kept(
        in_cells.groupBy(*cell)
        .agg(count.alias(n["held"]))
        .withColumn(n["ids"], ids)
        .withColumn(n["offset"], F.coalesce(F.sum(c["held"]).over(in_order), F.lit(0)))
        .withColumn(n["id"], F.coalesce(F.sum(c["ids"]).over(in_order), F.lit(0))),
        "order-cells",
    )
    tasks = cells.agg(F.sum(c["ids"])).first()[0]
    found = in_cells.join(F.broadcast(cells.drop(n["held"], n["ids"])), cell)

    # Equal rows: one row for every ``most`` of them, with its first place.
    one_by_one = found.filter(c["piece"] % 2 == 0).withColumns({n["at"]: F.lit(None).cast("long"), n["copies"]: F.lit(1).cast("long")})
    columns, plain = df.columns, _plain(df)
    rest = [n[name] for name in ("hash", "content", "slice", "segment", "part", "piece", "offset", "id")]
    earlier = Window.partitionBy(*cell).orderBy(F.xxhash64(F.lit(1), *[ref(x) for x in plain])).rowsBetween(Window.unboundedPreceding, -1)
    together = found.filter(c["piece"] % 2 == 1).groupBy(*[ref(x) for x in plain], *rest).agg(count.alias(n["held"]))
    start = c["offset"] + F.coalesce(F.sum(c["held"]).over(earlier), F.lit(0))
    step = F.lit(most).cast("long")
    last = c["nth"] + c["held"] - 1
    together = (
        together.withColumn(n["nth"], start)
        .withColumn(n["at"], F.explode(F.sequence(c["nth"], last, step)))
        .withColumn(n["copies"], F.least(step, last - c["at"] + 1))
        .withColumn(n["id"], c["id"] + _div(c["at"] - c["offset"], most))
        .drop(n["nth"], n["held"])
    )
    within = Window.partitionBy(n["id"]).orderBy(n["hash"], *[ref(k) for k in keys], n["content"])
    numbered = (
        (one_by_one.unionByName(together) if plain == columns else one_by_one)
        .withColumn(n["id"], c["id"].cast("int"))
        .repartitionById(tasks, n["id"])
        .withColumn(n["nth"], F.row_number().over(within))
        .withColumn(n["at"], F.coalesce(c["at"], c["offset"] + c["nth"] - 1))
    )
    places = F.explode(F.sequence(c["at"], c["at"] + c["copies"] - 1)).alias(column)
    return numbered.select(*[ref(x) for x in columns if x != column], places)


def _kept(df: DataFrame, label: str) -> DataFrame:
    """A small table, written once to the shared scratch folder."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _plain(df: DataFrame) -> list[str]:
    """Columns that can be hashed and compared."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [name for name, kind in kinds.items() if "map<" not in kind and kind != "variant"]


def _content_hash(df: DataFrame) -> Column:
    plain = [ref(name) for name in _plain(df)]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def _slice_of(hashed: Column, slices: int) -> Column:
    """Which of ``slices`` equal ranges of the hash a row falls into, by its first 32 bits."""
    head = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long")
    return F.shiftright(head * F.lit(slices).cast("long"), 32).cast("int")


def assign_ranks(df: DataFrame, world_size: int, position: str = "position") -> DataFrame:
    """Deal positions out to the ranks in turn."""
    _positive(world_size=world_size)
    return df.withColumn("rank", F.pmod(ref(position), F.lit(world_size).cast("long")))


def export_shards(
    df: DataFrame,
    path: str,
    world_size: int,
    position: str = "position",
    rows_per_file: int = 1_000_000,
) -> None:
    """Write one ``rank=`` directory per rank, rows in position order.

    Takes rows as ``seeded_order`` leaves them, consecutive positions task after
    task: each task then writes its stretch of every rank and nothing is
    shuffled again. Files in name order are in position order.
    """
    (
        assign_ranks(df, world_size, position)
        .sortWithinPartitions("rank", position)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("rank")
        .parquet(path)
    )


def assign_batches(
    df: DataFrame,
    world_size: int = 1,
    per_device_batch: int = 2,
    accumulation: int = 4,
    position: str = "position",
) -> DataFrame:
    """For each row the rank that sees it, the optimizer step and the micro step in it."""
    _positive(per_device_batch=per_device_batch, accumulation=accumulation)
    ranked = assign_ranks(df, world_size, position)
    nth_on_rank = _div(ref(position), world_size)
    micro_batch = _div(nth_on_rank, per_device_batch)
    return ranked.withColumn("step", _div(micro_batch, accumulation)).withColumn(
        "micro_step", F.pmod(micro_batch, F.lit(accumulation).cast("long"))
    )


def permuted(position: Column, num_rows: int, key: Column, rounds: int = 4) -> Column:
    """Where a permutation of 0 to ``num_rows`` - 1 that the key (a string) fixes takes a position.

    Nothing is sorted or looked up: the position is written as two digits, of
    bases near the root of ``num_rows``, and each is in turn moved on by a hash of the other
    (a Feistel network), which can be undone and so takes no two to the same
    place. The digits span a few places more than there are; from those the
    walk goes on until it is inside, which keeps it a permutation. More than a
    few steps are practically never needed, and beyond sixteen (or
    all places outside, if they are fewer) it is an error rather than a wrong
    place, as is a position outside the range.
    """
    _positive(num_rows=num_rows, rounds=rounds)
    high = math.isqrt(num_rows - 1) + 1
    low = -(-num_rows // high)
    as_long = lambda n: F.lit(n).cast("long")

    def hashed(turn: Column, digit: Column) -> Column:
        text = F.concat_ws(":", key, turn.cast("string"), digit.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")

    def digits(first: Column, second: Column) -> Column:
        return F.struct(first.alias("first"), second.alias("second"))

    def move(both: Column, turn: Column) -> Column:
        first, second = both["first"], both["second"]
        return F.when(turn % 2 == 0, digits((first + hashed(turn, second)) % as_long(high), second)).otherwise(
            digits(first, (second + hashed(turn, first)) % as_long(low))
        )

    def step(place: Column) -> Column:
        start = digits(_div(place, low), place % as_long(low))
        moved = F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, move)
        return moved["first"] * as_long(low) + moved["second"]

    inside = lambda place: place < as_long(num_rows)
    more = F.sequence(F.lit(1), F.lit(min(high, 16)))
    walked = F.aggregate(more, step(position), lambda place, _: F.when(inside(place), place).otherwise(step(place)))
    known = inside(position) & (position >= 0)
    lost = F.raise_error(F.concat(F.lit(f"no place among {num_rows} for position "), position.cast("string"))).cast("long")
    return F.transform(F.array(walked), lambda place: F.when(known & inside(place), place).otherwise(lost))[0]


def epoch_batches(
    df: DataFrame,
    epochs: float = 1,
    max_steps: int = -1,
    world_size: int = 1,
    per_device_batch: int = 2,
    accumulation: int = 4,
    seed: int = 42,
    position: str = "position",
    num_rows: int | None = None,
) -> DataFrame:
    """Each row once for every time that training sees it: ``epoch``, ``epoch_position``, ``rank``, ``step``, ``micro_step``.

    The first epoch takes the rows by their stored position, each later one in
    an order of its own (``permuted``) that seed and epoch fix. No epoch sorts or
    shuffles anything: rows are told where they go and stay where they are.
    ``step`` counts through all epochs; those from the total on are not there,
    so the last epoch may be cut short. The total is as in ``step_plan``: a positive
    ``max_steps`` wins over the epochs, which may be a fraction.

    Positions must be 0 to n - 1; n is counted unless ``num_rows`` says it (of a
    saved order, a count of footers). Without rows there are no steps.
    """
    _positive(world_size=world_size, per_device_batch=per_device_batch, accumulation=accumulation)
    if epochs < 0:
        raise ValueError(f"epochs must not be negative, got {epochs}")
    n = df.count() if num_rows is None else num_rows
    per_epoch = math.ceil(n / (world_size * per_device_batch * accumulation))
    total = max_steps if max_steps > 0 else math.ceil(per_epoch * epochs)
    passes = math.ceil(total / per_epoch) if per_epoch else 0
    numbers = F.sequence(F.lit(0), F.lit(passes - 1)) if passes else F.array().cast("array<int>")
    rows = df.withColumn("epoch", F.explode(numbers))
    key = F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"))
    own = permuted(ref(position), max(n, 1), key)
    rows = rows.withColumn("epoch_position", F.when(F.col("epoch") == 0, ref(position)).otherwise(own))
    dealt = assign_batches(rows, world_size, per_device_batch, accumulation, "epoch_position")
    step = F.col("step") + F.col("epoch").cast("long") * per_epoch
    return dealt.withColumn("step", step).filter(F.col("step") < total)


def step_plan(
    df: DataFrame,
    world_size: int = 1,
    per_device_batch: int = 2,
    accumulation: int = 4,
    epochs: float = 1,
    max_steps: int = -1,
    dry_run: bool = False,
) -> DataFrame:
    """One row: rows, effective batch, steps per epoch, total steps.

    A positive ``max_steps`` wins over the epochs; a dry run is five steps
    unless ``max_steps`` is given.
    """
    settings = dict(world_size=world_size, per_device_batch=per_device_batch, accumulation=accumulation)
    settings |= dict(epochs=epochs, max_steps=max_steps, dry_run=dry_run)
    return step_plans(df, {"only": settings}).drop("setting")


def step_plans(df: DataFrame, plans: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """A row of ``step_plan`` for each named setting, from one count of the rows."""
    counted = df.agg(F.count(F.lit(1)).alias("num_rows"))
    rows = [_planned(F.col("num_rows"), **settings).withField("setting", F.lit(name)) for name, settings in plans.items()]
    names = ("num_rows", "effective_batch", "steps_per_epoch", "total_steps")
    return counted.select(F.explode(F.array(*rows)).alias("plan")).select("plan.setting", *[f"plan.{n}" for n in names])


def _planned(
    num_rows: Column,
    world_size: int = 1,
    per_device_batch: int = 2,
    accumulation: int = 4,
    epochs: float = 1,
    max_steps: int = -1,
    dry_run: bool = False,
) -> Column:
    _positive(world_size=world_size, per_device_batch=per_device_batch, accumulation=accumulation)
    effective = world_size * per_device_batch * accumulation
    if dry_run and max_steps <= 0:
        max_steps = DRY_RUN_STEPS
    steps_per_epoch = F.ceil(num_rows / F.lit(effective))
    total = F.lit(max_steps).cast("long") if max_steps > 0 else F.ceil(steps_per_epoch * F.lit(float(epochs)))
    return F.struct(
        num_rows.alias("num_rows"),
        F.lit(effective).cast("long").alias("effective_batch"),
        steps_per_epoch.alias("steps_per_epoch"),
        total.alias("total_steps"),
    )


def _positive(**numbers: int) -> None:
    for name, value in numbers.items():
        if value < 1 or math.floor(value) != value:
            raise ValueError(f"{name} must be a positive whole number, got {value}")
