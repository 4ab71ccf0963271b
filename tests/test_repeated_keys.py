"""The seeded order where one key has very many rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomset.operators import order


@pytest.fixture(scope="module")
def hot(spark):
    """A key with a third of all rows, most of them different; equal rows beside them; other keys in every slice."""
    rows = [(1, f"t{i}") for i in range(400)] + [(1, "same")] * 130 + [(2, "equal")] * 90 + [(3, f"u{i % 40}") for i in range(80)]
    rows += [(i, "one") for i in range(10, 500)] + [(None, "none")] * 45
    return spark.createDataFrame(rows, "id int, text string")


def placed(df):
    return sorted((r["position"], r["id"], r["text"]) for r in df.collect())


@pytest.mark.parametrize("slices", [1, 4, 50])
@pytest.mark.parametrize("most", [20, 60])
def test_same_order_as_in_one_task(hot, slices, most):
    whole = placed(order.seeded_order(hot, "id", slices=3, most=10**9))
    assert [p for p, *_ in whole] == list(range(hot.count()))
    assert placed(order.seeded_order(hot.repartition(7), "id", slices=slices, most=most)) == whole


def test_no_task_has_many_rows_of_it(hot):
    """Tasks in turn hold the positions, each a bounded number of them; those of 4 slices would hold 300."""
    ordered = order.seeded_order(hot, "id", slices=40, most=30)
    held = ordered.select("position", F.spark_partition_id().alias("task")).collect()
    sizes = Counter(r["task"] for r in held)
    assert max(sizes.values()) <= 75 and len(sizes) > 40
    by_position = [r["task"] for r in sorted(held, key=lambda r: r["position"])]
    assert by_position == sorted(by_position)


def test_export_of_a_hot_key_is_in_order(hot, spark, tmp_path):
    path = str(tmp_path / "shards")
    order.export_shards(order.seeded_order(hot, "id", slices=4, most=25), path, world_size=2)
    for rank in range(2):
        rows = []
        for file in sorted((tmp_path / "shards" / f"rank={rank}").glob("*.parquet")):
            rows += [r["position"] for r in spark.read.parquet(str(file)).collect()]
        assert rows == list(range(rank, hot.count(), 2))


def test_equal_but_for_maps(spark):
    rows = [(1, {"m": i}) for i in range(60)] + [(2, {"m": 1})] * 5
    df = spark.createDataFrame(rows, "id int, extra map<string, int>")
    ordered = order.seeded_order(df, "id", slices=2, most=10).collect()
    assert sorted(r["position"] for r in ordered) == list(range(65))
    assert sorted(r["extra"]["m"] for r in ordered if r["id"] == 1) == list(range(60))


def test_columns_of_any_name_and_kind(spark):
    names = ("hash", "content", "slice", "heavy", "segment", "part", "piece", "own", "at", "copies", "nth", "held", "ids", "offset", "position")
    df = spark.range(90).select((F.col("id") % 2).alias("id"), *[F.array(F.lit(n)).alias(n) for n in names])
    got = order.seeded_order(df, "id", slices=2, most=10, column="place")
    assert got.columns == [*df.columns, "place"] and sorted(r["place"] for r in got.collect()) == list(range(90))


def test_unique_keys_are_taken_at_their_word(hot, monkeypatch):
    monkeypatch.setattr(order, "_order_in_cells", None)
    assert order.seeded_order(hot, "id", unique=True, most=1).count() == hot.count()
