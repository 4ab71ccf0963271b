"""Versions that appear at once: failures, conflicts, readers that have started."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from loomset.plans.preparation import prepare
from loomset.sources import files, published, readers


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "set")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_versions_follow_each_other(spark, path):
    assert not published.is_published(spark, path) and published.latest(spark, path) is None
    first = published.publish(spark.range(5), path, note={"why": "start"})
    assert (first.version, first.rows, first.columns, first.note) == (1, 5, ["id"], {"why": "start"})
    started = published.read_published(spark, path)
    published.publish(started.filter("id > 1").withColumn("kind", F.lit("x")), path, ["kind"])
    assert ids(started) == [0, 1, 2, 3, 4] and ids(published.read_published(spark, path)) == [2, 3, 4]
    assert published.read_published(spark, path).columns == ["id", "kind"]
    assert ids(published.read_published(spark, path, 1)) == [0, 1, 2, 3, 4]
    told = published.history(spark, path).orderBy("version").collect()
    assert [(r["version"], r["rows"]) for r in told] == [(1, 5), (2, 3)]
    for bad in (0, 3):
        with pytest.raises(ValueError, match="no version"):
            published.read_published(spark, path, bad)


def test_a_broken_job_leaves_the_former_version(spark, path):
    published.publish(spark.range(5), path)
    broken = spark.range(10).select(F.when(F.col("id") > 7, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        published.publish(broken, path)
    assert ids(published.read_published(spark, path)) == [0, 1, 2, 3, 4]
    assert ids(readers.reload_saved(spark, path)) == [0, 1, 2, 3, 4]
    assert published.publish(spark.range(2), path).version == 2


def test_one_of_two_writers_fails(spark, path):
    published.publish(spark.range(1), path)

    def write(n):
        try:
            return published.publish(spark.range(n), path, after=1).rows
        except published.ConflictError:
            return None

    with ThreadPoolExecutor(4) as pool:
        outcomes = list(pool.map(write, (10, 20, 30, 40)))
    won = [n for n in outcomes if n is not None]
    assert len(won) == 1 and published.read_published(spark, path).count() == won[0]
    lost = published.superseded(spark, path, keep=2)
    assert len(lost) == 3 and published.superseded(spark, path, keep=1) != lost
    assert all(os.path.isdir(p.removeprefix("file:")) for p in lost)


def test_commits_appear_whole_or_not(spark, path):
    assert published._write_once(spark, f"{path}/a.json", "x" * 10)
    assert not published._write_once(spark, f"{path}/a.json", "y")
    assert files.read_text(spark, f"{path}/a.json") == "x" * 10
    assert [n for n in os.listdir(path) if not n.endswith(".crc")] == ["a.json"]


def test_publish_once(spark, path):
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)

    os.makedirs(f"{path}/snapshot-00000001-left/_temporary")
    assert published.publish_once(spark, path, make) and not published.publish_once(spark, path, make)
    assert len(calls) == 1 and published.read_published(spark, path).count() == 3

    def overtaken():
        published.publish(spark.range(9), f"{path}2")
        return spark.range(3)

    assert not published.publish_once(spark, f"{path}2", overtaken)
    assert published.read_published(spark, f"{path}2").count() == 9


def test_preparation_published(spark, path, tmp_path):
    raw = str(tmp_path / "raw")
    spark.createDataFrame([("a", "b"), ("c", "d")], "instruction string, output string").write.parquet(raw)
    for n in (1, 2):
        report = prepare(spark, raw, path, "alpaca", max_samples=n, key="instruction", publish=True)
        assert report.rows_after == n and published.latest(spark, path).note == {"source": raw, "format": "alpaca"}
    with pytest.raises(Exception):  # noqa: B017 - whatever the function raises
        prepare(spark, raw, path, "x", row_function=lambda row: {"text": row["missing"]}, keep_empty=True, publish=True)
    saved = readers.read_source(spark, "local", path)
    assert saved.count() == 2 and "text" in saved.columns
    assert published.read_published(spark, path, 1).count() == 1


def test_no_rows(spark, path):
    published.publish(spark.range(0), path)
    assert published.read_published(spark, path).columns == ["id"] and published.latest(spark, path).rows == 0
    with pytest.raises(ValueError, match="nothing is published"):
        published.read_published(spark, f"{path}/elsewhere")
