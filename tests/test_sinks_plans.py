import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomset.plans.landing import land
from loomset.plans.preparation import prepare
from loomset.plans.training import SOURCE_KEY, export_for_ranks, training_rows
from loomset.session import scratch_dir
from loomset.sources import readers, sinks

from plans import plan_of


def write_lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def test_manifest_describes_what_was_saved(spark, tmp_path):
    path = str(tmp_path / "d" / "deep")
    sinks.save_dataset(spark.range(7).withColumn("text", F.lit("x")), path)
    sinks.save_manifest(spark, path, "in", "alpaca")
    assert tuple(sinks.read_manifest(spark, path).first()) == ("in", "alpaca", 7, ["id", "text"])
    assert readers.reload_saved(spark, path).columns == ["id", "text"]
    assert readers.read_raw(spark, path).count() == 7
    sinks.save_dataset(spark.range(2), path)
    assert readers.reload_saved(spark, path).count() == 2


def test_saving_replaces_every_partition_whatever_the_session_says(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.save_dataset(spark.range(4).selectExpr("id", "id p"), path, ["p"])
        sinks.save_dataset(spark.range(1).selectExpr("id", "id p"), path, ["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.parquet(path).count() == 1


def test_run_records(spark, tmp_path):
    path = str(tmp_path / "runs")
    sinks.save_run_record(spark, path, "r1", {"learning_rate": 1e-3})
    sinks.save_run_record(spark, path, "r1", {"learning_rate": 1e-3, "version_tag": "done"})
    sinks.save_run_record(spark, path, "r2")
    records = spark.read.parquet(path)
    assert records.count() == 3 and records.schema == sinks.run_record_schema()
    assert len(records.columns) == 18
    latest = {r["run"]: r for r in sinks.latest_run_records(records).collect()}
    assert latest["r1"]["version_tag"] == "done" and latest["r1"]["learning_rate"] == 1e-3
    assert latest["r2"]["max_seq_length"] == 512 and latest["r2"]["version_tag"] is None
    with pytest.raises(ValueError, match="colour"):
        sinks.save_run_record(spark, path, "r3", {"colour": 1})


def test_versioned_path():
    now = datetime(2024, 5, 6, 7, 8, 9)
    assert sinks.versioned_path("/out/", "v1.0", now=now) == "/out/v1.0"
    assert sinks.versioned_path("/out", now=now) == "/out/run_20240506_070809"
    assert sinks.versioned_path("/out", "", now=now) == "/out/run_20240506_070809"
    assert sinks.versioned_path("/out", "v1.0", enabled=False) == "/out"


def test_scratch_is_below_the_shared_folder(spark, monkeypatch, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path != scratch_dir(spark, "x")
    if base:
        assert path.startswith(base)


def test_landing(spark, tmp_path):
    source, output = write_lines(tmp_path / "a.jsonl", [{"id": 1}, {"id": 2}]), str(tmp_path / "out")
    report = land(spark, "local", output, path=source, skip_if_exists=True)
    assert report.landed and report.num_rows == 2 and report.num_files >= 1 and report.num_bytes > 0
    assert "id" in report.columns
    again = land(spark, "local", output, path=write_lines(tmp_path / "b.jsonl", [{"id": 3}]), skip_if_exists=True)
    assert not again.landed and again.num_rows == 2
    assert land(spark, "local", output, path=source, verify=False).num_files is None


def test_landing_from_an_exported_hub_table(spark, tmp_path):
    table, output = str(tmp_path / "hub"), str(tmp_path / "out")
    spark.range(10).selectExpr("id", "if(id < 3, 'test', 'train') split").write.partitionBy("split").parquet(table)
    assert land(spark, "huggingface", output, path=table, split="test").num_rows == 3
    with pytest.raises(ValueError, match="tset"):
        land(spark, "huggingface", output, path=table, split="tset")
    assert readers.reload_saved(spark, output).count() == 3
    # A file that is added leaves the rows before it.
    more = write_lines(tmp_path / "more.jsonl", [{"id": 100}, {"id": 101}])
    report = land(spark, "local", output, path=more)
    assert (report.num_rows, report.rows_landed) == (5, 2)
    assert {r["id"] for r in readers.read_raw(spark, output).collect()} == {0, 1, 2, 100, 101}


def test_landing_guards(spark, tmp_path):
    for arguments, message in (
        (dict(source="ftp"), "unknown source"),
        (dict(source="local"), "path"),
        (dict(source="huggingface"), "path"),
        (dict(source="s3"), "bucket"),
    ):
        with pytest.raises(ValueError, match=message):
            land(spark, output=str(tmp_path / "o"), **arguments)


def test_files_that_are_no_dataset_still_verify(spark, tmp_path):
    (tmp_path / "readme.txt").write_text("x")
    report = land(spark, "local", str(tmp_path), path="/nowhere", skip_if_exists=True)
    assert not report.landed and report.num_files == 1 and report.num_rows is None


TALKS = [
    {"id": 1, "conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]},
    {"id": 2, "conversations": []},
    {"id": 3, "conversations": [{"from": "tool", "value": "x"}]},
    {"id": 4, "conversations": [{"from": "human", "value": "again"}]},
]


def test_preparation(spark, tmp_path):
    source, output = write_lines(tmp_path / "talks.jsonl", TALKS), str(tmp_path / "out")
    report = prepare(spark, source, output, "sharegpt")
    assert (report.rows_before, report.rows_after) == (4, 2)
    assert report.columns == ("conversations", "id", "text")
    assert report.sample == "### Human:\nhi\n\n### Assistant:\nyo"
    assert tuple(sinks.read_manifest(spark, output).first())[:3] == (source, "sharegpt", 2)
    assert {r["id"] for r in readers.reload_saved(spark, output).collect()} == {1, 4}


def test_preparation_limits_before_it_filters(spark, tmp_path):
    source, output = write_lines(tmp_path / "talks.jsonl", TALKS), str(tmp_path / "out")
    for arguments in (dict(max_samples=3), dict(max_samples=3, key="id")):
        report = prepare(spark, source, output, "sharegpt", **arguments)
        assert (report.rows_before, report.rows_after) == (3, 1)
    assert prepare(spark, source, output, "sharegpt", max_samples=0).rows_before == 4
    assert prepare(spark, source, output, "sharegpt", max_samples=99).rows_before == 4


def test_leading_rows_of_lines_and_arrays_together(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_lines(source / "a.jsonl", [{"id": i, "q": "x", "r": "y"} for i in range(5)])
    (source / "b.json").write_text(json.dumps([{"id": i, "q": "x", "r": "y"} for i in range(5, 9)], indent=1))
    report = prepare(spark, str(source), str(tmp_path / "out"), "custom", 7, instruction_col="q", response_col="r")
    assert (report.rows_before, report.rows_after) == (7, 7)
    assert sorted(r["id"] for r in readers.reload_saved(spark, str(tmp_path / "out")).collect()) == list(range(7))


def test_jobs_pass_on_how_files_are_read(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text("q,r\nNA,1\nwhy,2\n")
    reading = readers.Reading(na_values=["NA"], infer_types=True, multi_line=False)
    columns = dict(instruction_col="q", response_col="r")
    prepare(spark, str(source), str(tmp_path / "out"), "custom", reading=reading, **columns)
    rows = {r["r"]: r["q"] for r in readers.reload_saved(spark, str(tmp_path / "out")).collect()}
    assert rows == {1: None, 2: "why"}
    assert land(spark, "local", str(tmp_path / "landed"), path=str(source), reading=reading).rows_landed == 2
    assert readers.reload_saved(spark, str(tmp_path / "landed")).filter("q IS NULL").count() == 1
    trained = training_rows(spark, "local", str(source), key="r", text_field="q", reading=reading)
    assert sorted((r["r"], r["text"]) for r in trained.collect()) == [(1, None), (2, "why")]


def test_slices_grow_with_the_bytes(spark, tmp_path):
    path = str(tmp_path / "saved")
    sinks.save_dataset(spark.range(50).selectExpr("uuid() text"), path)
    few = training_rows(spark, "local", path)
    many = training_rows(spark, "local", path, bytes_per_slice=100)
    assert plan_of(few) != plan_of(many)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_preparation_keeps_empty_on_request(spark, tmp_path):
    source, output = write_lines(tmp_path / "talks.jsonl", TALKS), str(tmp_path / "out")
    assert prepare(spark, source, output, "sharegpt", keep_empty=True).rows_after == 4


def test_preparation_of_only_empty_rows_writes_nothing(spark, tmp_path):
    source, output = write_lines(tmp_path / "talks.jsonl", TALKS[1:3]), tmp_path / "out"
    with pytest.raises(ValueError, match="empty"):
        prepare(spark, source, str(output), "sharegpt")
    assert not output.exists()
    assert prepare(spark, source, str(output), "sharegpt", keep_empty=True).rows_after == 2


def test_preparation_with_a_python_formatter(spark, tmp_path):
    source = write_lines(tmp_path / "q.jsonl", [{"q": "a", "n": 1}, {"q": " ", "n": 2}])
    report = prepare(spark, source, str(tmp_path / "o"), "mine", row_function=lambda r: {"text": r["q"].strip()})
    assert (report.rows_before, report.rows_after) == (2, 1)


def test_prepared_alpaca_is_rendered_anew_for_training(spark, tmp_path):
    source = write_lines(tmp_path / "a.jsonl", [{"instruction": f"i{i}", "input": "", "output": f"o{i}"} for i in range(40)])
    prepared, shards = str(tmp_path / "prepared"), str(tmp_path / "shards")
    prepare(spark, source, prepared, "chatml")
    rows = training_rows(spark, "local", prepared, seed=7)
    assert rows.columns == [*SOURCE_KEY, "text", "position"]
    assert all("appropriately     completes" in r["text"] for r in rows.collect())
    export_for_ranks(spark, "local", prepared, shards, world_size=4, seed=7)
    read_back = spark.read.parquet(shards)
    assert read_back.count() == 40
    assert read_back.filter(F.col("position") % 4 != F.col("rank")).count() == 0
    assert sorted(r["position"] for r in read_back.collect()) == list(range(40))


def test_slices_grow_with_the_rows(spark, tmp_path):
    path = str(tmp_path / "saved")
    sinks.save_dataset(spark.range(100).selectExpr("cast(id AS string) text"), path)
    few = training_rows(spark, "local", path)
    many = training_rows(spark, "local", path, rows_per_slice=9)
    assert ", 12), REPARTITION_BY_NUM" in plan_of(many)
    assert "REPARTITION_BY_NUM" in plan_of(few) and ", 12)" not in plan_of(few)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_training_rows_with_key_and_cap(spark, tmp_path):
    source = write_lines(tmp_path / "a.jsonl", [{"id": i, "text": "a b c"} for i in range(10)])
    with pytest.raises(ValueError, match="key"):
        training_rows(spark, "local", source)
    rows = training_rows(spark, "local", source, key="id", max_seq_length=2).collect()
    assert sorted(r["position"] for r in rows) == list(range(10))
    assert all(r["tokens"] == ["a", "b"] and r["truncated"] for r in rows)


class FakeSession:
    """Just the settings scratch_dir looks at."""

    def __init__(self, master, base=None):
        self.conf = {"spark.checkpoint.dir": base} if base else {}
        self.sparkContext = type("Context", (), {"master": master})()


def test_scratch_falls_back_only_when_local():
    assert scratch_dir(FakeSession("yarn", "hdfs:///shared"), "x").startswith("hdfs:///shared/x-")
    assert "loomset-" in scratch_dir(FakeSession("local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession("yarn"), "x")
