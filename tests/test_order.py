import math

import pytest
from pyspark.sql import functions as F

from loomset.operators import order
from loomset.operators.metrics import latest_metrics, metric_rollup
from loomset.operators.retention import retain_last_k
from loomset.operators.turns import assemble_conversations, pair_turns

from plans import plan_of


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("text"))


def positions(df):
    return {r["id"]: r["position"] for r in df.collect()}


def test_order_is_a_dense_permutation_fixed_by_the_seed(numbers):
    first = positions(order.seeded_order(numbers, "id", seed=1))
    assert sorted(first.values()) == list(range(1000))
    assert first == positions(order.seeded_order(numbers.repartition(13), "id", seed=1))
    assert first == positions(order.seeded_order(numbers, "id", seed=1, slices=37))
    assert first == positions(order.seeded_order(numbers, "id", seed=1, slices=1))
    assert first != positions(order.seeded_order(numbers, "id", seed=2))
    assert first != {i: i for i in range(1000)}


def test_order_can_be_drawn_again(numbers):
    again = order.seeded_order(order.seeded_order(numbers, "id", seed=1), "id", seed=2)
    assert again.columns == ["id", "text", "position"]
    assert positions(again) == positions(order.seeded_order(numbers, "id", seed=2))
    with pytest.raises(ValueError):
        order.seeded_order(numbers, "id", slices=order.MAX_SLICES + 1)


def test_order_over_several_keys(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("a"), F.col("id").alias("id"))
    assert sorted(positions(order.seeded_order(df, ["a", "id"])).values()) == list(range(100))


def test_order_moves_each_row_once(numbers):
    plan = plan_of(order.seeded_order(numbers, "id"))
    with_text = [line for line in plan.splitlines() if "Exchange" in line]
    assert sum("shufflepartitionidpassthrough" in line for line in with_text) == 1
    # The counting side: counts per slice, then their running sum in one task, then the broadcast.
    assert len(with_text) == 4
    single = plan.index("SinglePartition")
    assert "text" not in plan[single:]


def test_rows_that_repeat_a_key_have_a_fixed_order(spark):
    rows = [(i % 7, f"t{i}", {"m": i}) for i in range(300)] + [(0, "same", {"m": 1})] * 3
    df = spark.createDataFrame(rows, "id int, text string, extra map<string, int>")
    first = sorted((r["text"], r["position"]) for r in order.seeded_order(df, "id", slices=5).collect())
    again = sorted((r["text"], r["position"]) for r in order.seeded_order(df.repartition(9), "id", slices=5).collect())
    assert first == again and sorted(p for _, p in first) == list(range(303))


def test_columns_named_like_the_operators_own_survive(spark):
    names = ("_hash", "_slice", "_row", "_offset", "hash", "slice", "nth", "held", "offset", "content", "Hash")
    df = spark.range(40).select("id", *[F.concat(F.lit(n), "id").alias(n) for n in names])
    got = order.seeded_order(df, "id", slices=3)
    assert got.columns == [*df.columns, "position"]
    for row in got.collect():
        assert all(row[n] == f"{n}{row['id']}" for n in names)
    kept = retain_last_k(df.select("id", F.lit(1).alias("nth"), F.lit(2).alias("of_group"), F.lit(3).alias("oldest_kept")), "nth", "id", 2)
    assert {(r["nth"], r["of_group"], r["oldest_kept"]) for r in kept.collect()} == {(1, 2, 3)}
    assert kept.filter("NOT expired").count() == 2


def test_export_writes_each_rank_in_order(spark, numbers, tmp_path):
    path = str(tmp_path / "shards")
    ordered = order.seeded_order(numbers, "id")
    order.export_shards(ordered, path, world_size=3, rows_per_file=50)
    for rank in range(3):
        rows = []
        for file in sorted((tmp_path / "shards" / f"rank={rank}").glob("*.parquet")):
            in_file = [r["position"] for r in spark.read.parquet(str(file)).collect()]
            assert len(in_file) <= 50
            rows += in_file
        assert rows == list(range(rank, 1000, 3))


def test_batches(numbers):
    df = order.assign_batches(
        order.seeded_order(numbers, "id"), world_size=3, per_device_batch=2, accumulation=4
    )
    steps = {}
    for r in df.collect():
        steps.setdefault((r["step"], r["micro_step"], r["rank"]), []).append(r["position"])
    effective = 3 * 2 * 4
    assert {s for s, _, _ in steps} == set(range(math.ceil(1000 / effective)))
    assert all(len(p) <= 2 for p in steps.values())
    for (step, micro, rank), held in steps.items():
        assert all(step * effective <= p < (step + 1) * effective for p in held)
        assert 0 <= micro < 4 and all(p % 3 == rank for p in held)


@pytest.mark.parametrize(
    "settings, expected",
    [
        (dict(), (1000, 8, 125, 125)),
        (dict(world_size=3, per_device_batch=2, accumulation=4, epochs=2), (1000, 24, 42, 84)),
        (dict(epochs=0.5), (1000, 8, 125, 63)),
        (dict(max_steps=7, epochs=3), (1000, 8, 125, 7)),
        (dict(dry_run=True), (1000, 8, 125, 5)),
        (dict(dry_run=True, max_steps=9), (1000, 8, 125, 9)),
    ],
)
def test_step_plan(numbers, settings, expected):
    assert tuple(order.step_plan(numbers, **settings).first()) == expected


def test_settings_must_be_positive(numbers):
    for bad in (dict(world_size=0), dict(per_device_batch=0), dict(accumulation=-1)):
        with pytest.raises(ValueError):
            order.step_plan(numbers, **bad)


def test_retention(spark):
    rows = [("a", i) for i in range(6)] + [("b", 1), ("b", 2), (None, 5), (None, 6), (None, 7), (None, 8), ("c", None)]
    df = spark.createDataFrame(rows, "run string, step int")
    kept = {(r["run"], r["step"]) for r in retain_last_k(df, "run", "step", 3).filter("not expired").collect()}
    assert kept == {("a", 3), ("a", 4), ("a", 5), ("b", 1), ("b", 2), (None, 6), (None, 7), (None, 8)}
    assert retain_last_k(df, "run", "step", 3).count() == len(rows)
    with pytest.raises(ValueError):
        retain_last_k(df, "run", "step", 0)


def test_retention_prunes_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("run"), F.col("id").alias("step"))
    plan = plan_of(retain_last_k(df, "run", "step", 3))
    assert "row_number(), 3, Partial" in plan


def test_assembly_keeps_turn_order_across_runs(spark):
    turns = spark.range(500).select(
        F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("conv_id"),
        F.when(F.col("id") < 300, F.col("id")).otherwise(0).alias("turn"),
        F.lit("user").alias("role"),
        F.col("id").cast("string").alias("text"),
    ).repartition(7)
    for block in (1, 7, 1024):
        nested = assemble_conversations(turns, block=block)
        assert nested.columns == ["conv_id", "conversations"]
        rows = {r["conv_id"]: [m["value"] for m in r["conversations"]] for r in nested.collect()}
        assert rows[0] == [str(i) for i in range(300)]
        assert len(rows) == 201 and rows[300] == ["300"]


def test_assembly_spreads_conversations_over_runs(spark):
    turns = spark.range(10_000).selectExpr("id div 5000 conv_id", "id % 5000 turn", "'user' role", "'x' text")
    plan = plan_of(assemble_conversations(turns))
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 2 and "_groupingexpression" in exchanges[-1]
    # Without runs one shuffle does, whatever the turn numbers are.
    assert plan_of(assemble_conversations(turns, block=None)).count("Exchange") == 1
    nested = assemble_conversations(turns, block=None).collect()
    assert [len(r["conversations"]) for r in nested] == [5000, 5000]


def test_assembly_with_negative_turns(spark):
    turns = spark.createDataFrame([(1, t, "user", str(t)) for t in (-3, 2, 0, -1)],
                                  "conv_id int, turn int, role string, text string")
    row = assemble_conversations(turns, block=2).first()
    assert [m["value"] for m in row["conversations"]] == ["-3", "-1", "0", "2"]


def test_metric_rollup_and_latest(spark):
    log = spark.sql(
        """SELECT * FROM VALUES
        ('r', 1L, TIMESTAMP_NTZ'2024-01-01 00:10:00', 'loss', 2.0D),
        ('r', 2L, TIMESTAMP_NTZ'2024-01-01 00:50:00', 'loss', 1.0D),
        ('r', 3L, TIMESTAMP_NTZ'2024-01-01 01:00:00', 'loss', 0.123456D),
        ('s', 9L, TIMESTAMP_NTZ'2024-01-01 01:00:00', 'lr', 2e-4D)
        AS t(run_id, step, ts, tag, value)"""
    )
    rows = {(str(r["window_start"]), r["tag"]): tuple(r)[3:] for r in metric_rollup(log).collect()}
    assert rows == {
        ("2024-01-01 00:00:00", "loss"): (2, 1.5, 1.0, 2.0),
        ("2024-01-01 01:00:00", "loss"): (1, 0.123456, 0.123456, 0.123456),
        ("2024-01-01 01:00:00", "lr"): (1, 2e-4, 2e-4, 2e-4),
    }
    latest = {r["run_id"]: (r["loss"], r["lr"]) for r in latest_metrics(log, ["loss", "lr"]).collect()}
    assert latest == {"r": ("0.1235", "N/A"), "s": ("N/A", "0.0002")}


def test_pairs_survive_gaps_and_long_conversations(spark):
    turns = [(1, 0, "system", "ctx"), (1, 1, "user", "q1"), (1, 7, "assistant", "a1"), (1, 9, "assistant", "a1b"), (1, 50, "user", "q2"),
             (1, 3000, "assistant", "a2"), (1, 9000, "user", "q3"), (2, 0, "user", "x"), (2, 1, "tool", "y"), (2, 2, "assistant", "z"),
             (3, 5, "user", None), (3, 6, "assistant", None), (None, 1, "user", "nq"), (None, 2, "assistant", "na"), (4, -9, "user", "m"), (4, 9, "assistant", "n")]
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    want = {(1, 1, "q1", "ctx", "a1"), (1, 50, "q2", "ctx", "a2"), (3, 5, None, "", None), (None, 1, "nq", "", "na"), (4, -9, "m", "", "n")}
    for block in (1, 2, 64, 1024):
        assert {tuple(r) for r in pair_turns(df, block=block).collect()} == want, block
    long = spark.range(5000).select(
        F.lit(1).alias("conv_id"), (F.col("id") * 3).alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), "id").alias("text"),
    )
    assert pair_turns(long).count() == 2500


def test_latest_metrics_round_as_python_does(spark):
    rows = [("r", 1, "2024-01-01", "loss", 0.03125), ("s", 1, "2024-01-01", "loss", 1.00015), ("s", 2, "2023-01-01", "loss", 9.0), ("t", 1, None, "loss", 2.5),
            ("t", 2, None, "loss", None), ("u", 5, "2024-01-01", "loss", 1.0), ("u", 5, "2024-01-01", "loss", 2.0)]
    log = spark.createDataFrame(rows, "run_id string, step int, ts string, tag string, value double")
    got = {r["run_id"]: r["loss"] for r in latest_metrics(log, ["loss"]).collect()}
    assert got == {"r": "0.0312", "s": f"{1.00015:.4f}", "t": "2.5000", "u": "2.0000"}
