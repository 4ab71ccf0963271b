"""The n-th place against sorting, on keys of all sorts."""

import pytest
from pyspark.sql import functions as F

from loomset.operators import selection
from loomset.sources import positions
from plans import plan_of


def place(df, n, *names, few=4):
    found = selection.nth_place(df, n, [F.col(c).alias(c) for c in names], few)
    return None if found is None else tuple(found)


@pytest.fixture(scope="module")
def mixed(spark):
    """Nulls, ties, a key that holds a third of all rows, negative numbers and odd strings."""
    rows = [(None, i, "x") for i in range(20)]
    rows += [("hot", 5, "same")] * 300
    rows += [(f"k{i % 37}", (i * 7919) % 211 - 100, "é" * (i % 3)) for i in range(600)]
    return spark.createDataFrame(rows, "a string, b int, c string").repartition(5).cache()


@pytest.mark.parametrize("n", [1, 4, 5, 20, 21, 200, 319, 320, 321, 500, 919, 920])
def test_like_sorting(mixed, n):
    rows = [tuple(r) for r in mixed.orderBy("a", "b", "c").collect()]
    assert place(mixed, n, "a", "b", "c") == rows[n - 1]


def test_beyond_the_end(mixed, spark):
    assert place(mixed, 921, "a", "b", "c") is None
    assert place(mixed.limit(0), 1, "a") is None and place(mixed.limit(0), 100, "a") is None


def test_equal_rows_only(spark):
    same = spark.range(0, 5000, 1, 3).select(F.lit(7).alias("a"))
    assert place(same, 3000, "a") == (7,)
    assert place(same.select(F.lit(None).cast("int").alias("a")), 3000, "a") == (None,)


def test_numbers_that_are_none(spark):
    df = spark.createDataFrame([(float("nan"),)] * 40 + [(float("inf"),)] * 40 + [(float(i),) for i in range(40)], "a double")
    assert [place(df, n, "a")[0] for n in (40, 41, 80)] == [39.0, float("inf"), float("inf")]
    assert str(place(df, 81, "a")[0]) == "nan"


def test_few_rounds_read_few_columns(spark, monkeypatch):
    """A wide range is cut 64-fold: two rounds find one of 200,000, and no limit grows with n."""
    plans = []
    whole = selection._parts
    monkeypatch.setattr(selection, "_parts", lambda df, *rest: plans.append(plan_of(df)) or whole(df, *rest))
    limits = []
    last = selection._last_of_first
    monkeypatch.setattr(selection, "_last_of_first", lambda df, n: limits.append(n) or last(df, n))
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("a"), F.col("id").cast("string").alias("b"))
    expected = sorted(i * 7919 % 200_003 for i in range(200_000))[123_455]
    assert place(df, 123_456, "a", few=selection.FEW) == (expected,)
    assert len(plans) <= 3 and all(n <= selection.FEW for n in limits)


def test_bounds_reach_the_scan(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(20_000).withColumn("text", F.lit("wide")).repartition(3).write.parquet(path)
    plans = []
    whole = selection._parts
    monkeypatch.setattr(selection, "_parts", lambda df, *rest: plans.append(plan_of(df)) or whole(df, *rest))
    assert place(spark.read.parquet(path), 10_000, "id", few=100) == (9999,)
    assert "GreaterThanOrEqual(id," in plans[-1] and all("text" not in plan.split("ReadSchema")[1] for plan in plans)


def test_row_of_a_filtered_file(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 30_000, 1, 1).write.parquet(path)
    odd = spark.read.parquet(path).filter("id % 2 = 1")
    assert positions.place_of_nth(odd, 12_000)[1] == 23_999
    assert sorted(r.id for r in positions.rows_between(odd, 12_000, 12_003).collect()) == [24_001, 24_003, 24_005]
