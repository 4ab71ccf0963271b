"""Resuming by step: the rows a run has yet to see, from the files that hold them."""

import shutil

import pytest
from pyspark.sql import functions as F

from loomset.operators import order
from loomset.plans.training import export_for_ranks
from loomset.sources import shards


@pytest.fixture(scope="module")
def exported(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("resume")
    spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("text")).write.parquet(str(base / "in"))
    export_for_ranks(spark, "local", str(base / "in"), str(base / "a b+%20"), 4, rows_per_file=50)
    return str(base / "a b+%20")


def test_the_index_tells_every_file(spark, exported):
    told = shards.read_index(spark, exported).collect()
    assert sum(r["rows"] for r in told) == 1000 and {r["rank"] for r in told} == {0, 1, 2, 3}
    assert all(r["first"] % 4 == r["rank"] == r["last"] % 4 and r["rows"] == (r["last"] - r["first"]) // 4 + 1 for r in told)


@pytest.mark.parametrize(("step", "stop", "rank"), [(0, None, None), (7, None, None), (7, 9, None), (30, None, 2), (31, None, 1), (32, None, None), (5, 5, 0)])
def test_what_is_left(spark, exported, step, stop, rank):
    left = shards.read_from_step(spark, exported, step, 4, 2, 4, rank, stop)
    seen = order.assign_batches(spark.read.parquet(exported).drop("rank"), 4, 2, 4)
    want = seen.filter((F.col("step") >= step) & (F.col("step") < (stop if stop is not None else 10**6)))
    if rank is not None:
        want = want.filter(F.col("rank") == rank)
    columns = ["position", "text", "rank"]
    assert left.columns == spark.read.parquet(exported).columns
    assert sorted(map(tuple, left.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_only_files_that_hold_it_are_opened(spark, exported):
    whole = spark.read.parquet(exported).inputFiles()
    assert len(whole) >= 20
    late = shards.read_from_step(spark, exported, 30, 4, 2, 4)
    assert len(late.inputFiles()) <= len(whole) // 3
    assert len(shards.read_from_step(spark, exported, 30, 4, 2, 4, rank=1).inputFiles()) == 1
    between = shards.read_from_step(spark, exported, 12, 4, 2, 4, stop=13)
    assert 0 < len(between.inputFiles()) <= 8
    opened = {r[0] for r in between.select("_metadata.file_path").distinct().collect()}
    assert len(opened) == len(between.inputFiles())


def test_shards_can_be_moved(spark, exported, tmp_path):
    moved = str(tmp_path / "moved")
    shutil.copytree(exported, moved)
    assert shards.read_from_step(spark, moved, 30, 4, 2, 4).count() == 1000 - 30 * 32


def test_wrong_questions(spark, exported):
    for step, stop in ((-1, None), (3, 2)):
        with pytest.raises(ValueError):
            shards.read_from_step(spark, exported, step, 4, stop=stop)
    with pytest.raises(ValueError, match="ranks"):
        shards.read_from_step(spark, exported, 0, 2)
