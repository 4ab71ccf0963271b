"""Orders of later epochs, and length percentiles, against plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from loomset.operators import lengths, order
from plans import plan_of


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 16, 17, 99, 1000, 4097])
def test_permuted_is_a_permutation(spark, n):
    rows = spark.range(n).select(*[order.permuted(F.col("id"), n, F.lit(f"k{k}")).alias(f"p{k}") for k in range(3)]).collect()
    seen = [[r[k] for r in rows] for k in range(3)]
    assert all(sorted(s) == list(range(n)) for s in seen)
    if n > 16:
        assert seen[0] != seen[1] != seen[2] and list(range(n)) not in seen


def test_permuted_spreads(spark):
    """Neighbours land far apart: about a third of the range on average."""
    n = 4000
    places = [r[0] for r in spark.range(n).select(order.permuted(F.col("id"), n, F.lit("x"))).collect()]
    apart = [abs(a - b) for a, b in zip(places, places[1:])]
    assert 0.28 * n < sum(apart) / len(apart) < 0.39 * n


def plain(n, total, world, per_device, accumulation, orders):
    """What a trainer's loop does: ranks take turns, batches fill up, steps count on from epoch to epoch."""
    per_epoch = math.ceil(n / (world * per_device * accumulation))
    out = set()
    for epoch, places in enumerate(orders):
        for row, place in enumerate(places):
            micro = place // world // per_device
            step = epoch * per_epoch + micro // accumulation
            if step < total:
                out.add((row, epoch, place % world, step, micro % accumulation))
    return out


@pytest.mark.parametrize(("n", "epochs", "max_steps"), [(50, 1, -1), (50, 2.5, -1), (50, 3, 5), (50, 1, 17), (9, 4, -1), (1, 2, -1), (50, 0, -1)])
def test_epoch_batches_like_a_loop(spark, n, epochs, max_steps):
    rows = spark.range(n).withColumnRenamed("id", "position")
    got = order.epoch_batches(rows, epochs, max_steps, 2, 2, 2, seed=3)
    told = [tuple(r) for r in got.select("position", "epoch", "rank", "step", "micro_step").collect()]
    orders = [list(range(n))]
    for epoch in range(1, 60):
        key = F.lit(f"3:{epoch}")
        orders.append([r[0] for r in rows.select(order.permuted(F.col("position"), n, key)).collect()] if epoch < 6 else range(0))
    total = order.step_plan(rows, 2, 2, 2, epochs, max_steps).first()["total_steps"]
    assert len(told) == len(set(told)) and set(told) == plain(n, total, 2, 2, 2, orders)


def test_epoch_batches_moves_no_rows(spark):
    rows = spark.range(1000).withColumnRenamed("id", "position")
    assert "Exchange" not in plan_of(order.epoch_batches(rows, 3, num_rows=1000))
    assert order.epoch_batches(rows.limit(0), 3).count() == 0
    with pytest.raises(ValueError):
        order.epoch_batches(rows, -1)
    with pytest.raises(Exception, match="no place among 17"):
        spark.range(1).select(order.permuted(F.lit(10**9), 17, F.lit("k")) + F.lit(0)).collect()


def test_percentiles_of_groups(spark):
    counts = {"a": [5] * 2000 + [1, 2, 3], "b": [7], None: list(range(1, 101)), "c": [0, 0, 9]}
    rows = [(g, "w " * n) for g, ns in counts.items() for n in ns] + [("d", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, text string").repartition(4)
    for r in lengths.length_report(df, "g", 5, percentiles=(1, 50, 90, 99, 100)).collect():
        ns = sorted(counts.get(r["g"], [0, 0]))
        assert r["num_rows"] == len(ns) and r["num_tokens"] == sum(ns) and r["max_tokens"] == ns[-1]
        assert r["num_truncated"] == sum(n > 5 for n in ns) and r["tokens_cut"] == sum(max(n - 5, 0) for n in ns)
        assert r["mean_tokens"] == pytest.approx(sum(ns) / len(ns))
        for k in (1, 50, 90, 99, 100):
            assert r[f"p{k}_tokens"] == ns[max(math.ceil(k * len(ns) / 100), 1) - 1]


def test_percentiles_without_groups_or_rows(spark):
    df = spark.createDataFrame([("a b c",), (None,), ("",)], "text string")
    whole = lengths.length_report(df, percentiles=(50,)).first()
    assert (whole["num_rows"], whole["p50_tokens"], whole["max_tokens"]) == (3, 0, 3)
    none = lengths.length_report(df.limit(0)).first()
    assert (none["num_rows"], none["num_tokens"], none["p50_tokens"]) == (0, 0, None)
    own = lengths.length_report(df.withColumn("n", F.lit(4)), n_tokens=F.col("n"), percentiles=(90,)).first()
    assert own["p90_tokens"] == 4 and own["num_tokens"] == 12
    with pytest.raises(ValueError):
        lengths.length_report(df, percentiles=(0,))


def test_percentiles_come_from_the_histogram(spark):
    """Rows are summed up before they are shuffled: a hot group sends its different counts, not its rows."""
    df = spark.range(1000).select(F.lit("hot").alias("g"), F.lit("one two").alias("text"))
    plan = plan_of(lengths.length_report(df, "g"))
    assert "partial_count(1)" in plan.split("Exchange")[-1]
