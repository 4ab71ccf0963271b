import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException

from loomset.sources import files, landing, readers

ROWS = [{"id": i, "text": f"text {i}"} for i in range(5)]


def ids(df):
    return sorted(int(r["id"]) for r in df.collect())


def write_lines(path, rows=ROWS):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def write_array(path, rows=ROWS, indent=2):
    path.write_text(json.dumps(rows, indent=indent))
    return str(path)


@pytest.mark.parametrize("suffix", ["json", "jsonl"])
def test_json_lines_and_arrays(spark, tmp_path, suffix):
    assert ids(readers.read_file(spark, write_lines(tmp_path / f"a.{suffix}"))) == list(range(5))
    assert ids(readers.read_file(spark, write_array(tmp_path / f"b.{suffix}"))) == list(range(5))
    assert ids(readers.read_file(spark, write_array(tmp_path / f"c.{suffix}", indent=None))) == list(range(5))


def test_json_array_after_mark_and_space(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_bytes(b"\xef\xbb\xbf" + b" \n" * 3000 + json.dumps(ROWS, indent=1).encode())
    assert files.first_byte(spark, str(path)) == b"["


def test_mixed_json_directory_is_joined_by_name(spark, tmp_path):
    write_lines(tmp_path / "a.jsonl", [{"id": 1, "text": "x"}])
    write_array(tmp_path / "b.json", [{"id": 2, "extra": "y"}])
    rows = {r["id"]: r.asDict() for r in readers.read_raw(spark, str(tmp_path)).collect()}
    assert rows == {1: {"id": 1, "text": "x", "extra": None}, 2: {"id": 2, "text": None, "extra": "y"}}


def test_one_array_among_many_files_of_lines(spark, tmp_path):
    for n in range(205):
        write_lines(tmp_path / f"f{n:04}.json", [{"id": n, "text": "t"}])
    write_array(tmp_path / "z.json", [{"id": 900, "text": "x"}, {"id": 901, "text": "y"}])
    assert ids(readers.read_raw(spark, str(tmp_path))) == [*range(205), 900, 901]


def test_hidden_names_are_refused(spark, tmp_path):
    write_lines(tmp_path / "b.jsonl")
    write_lines(tmp_path / "_a.jsonl")
    with pytest.raises(ValueError, match="_a.jsonl"):
        readers.read_raw(spark, str(tmp_path))


def test_csv_files_with_other_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,x\n")
    (tmp_path / "b.csv").write_text("text,id\ny,2\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_raw(spark, str(tmp_path)).collect()


def test_several_arrays_in_one_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 0}, {"id": 1}]\n[{"id": 2}]\n')
    write_array(tmp_path / "b.json", [{"id": 3}], indent=None)
    assert ids(readers.read_raw(spark, str(tmp_path))) == [0, 1, 2, 3]


def test_array_with_a_record_per_line(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 0},\n{"id": 1},\n{"id": 2}]\n')
    (tmp_path / "b.json").write_text('[\n{"id": 3},\n{"id": 4}\n]\n')
    assert ids(readers.read_raw(spark, str(tmp_path))) == [0, 1, 2, 3, 4]
    assert ids(readers.read_json(spark, str(tmp_path), schema="id int")) == [0, 1, 2, 3, 4]


def test_named_layout_and_schema(spark, tmp_path):
    path = write_lines(tmp_path / "a.json")
    assert ids(readers.read_json(spark, path, schema="id int", layout="lines")) == list(range(5))
    with pytest.raises(ValueError):
        readers.read_json(spark, path, layout="rows")


def test_broken_json_line_fails(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": 1}\n{"id": \n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_file(spark, str(path)).collect()


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,text,note\n1,"two\nlines","say ""hi"""\n2,NA,\n3," padded ",x\\y\n')
    rows = [tuple(r) for r in readers.read_file(spark, str(path)).orderBy("id").collect()]
    assert rows == [("1", "two\nlines", 'say "hi"'), ("2", "NA", None), ("3", " padded ", "x\\y")]
    nulled = readers.read_csv(spark, str(path), na_values=["NA"]).orderBy("id").collect()
    assert [r["text"] for r in nulled] == ["two\nlines", None, " padded "]


def test_csv_with_inferred_types(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b,c,d,e\n1,1.50,true,2024-01-02,x\n2,NA,false,2024-01-03,NA\n")
    typed = readers.read_csv(spark, str(path), infer_types=True)
    assert dict(typed.dtypes)["a"] == "int" and dict(typed.dtypes)["c"] == "boolean"
    assert dict(typed.dtypes)["d"] == "string"
    path.write_text("a,b,c,d,e\n1,1.50,true,2024-01-02,x\n")
    row = readers.read_csv(spark, str(path), infer_types=True, na_values=["x"]).first()
    assert tuple(row) == (1, 1.5, True, "2024-01-02", None)


def test_suffixes(spark, tmp_path):
    other = tmp_path / "a.txt"
    other.write_text("id,text\n1,x\n")
    with pytest.raises(ValueError, match="txt"):
        readers.read_raw(spark, str(other))
    assert ids(readers.read_source(spark, "local", str(other))) == [1]


def test_directory_probe_order(spark, tmp_path):
    frame = spark.createDataFrame(ROWS)
    base = tmp_path / "d"
    base.mkdir()
    with pytest.raises(ValueError, match="no supported data files"):
        readers.read_raw(spark, str(base))
    (base / "c.csv").write_text("id,text\n30,c\n")
    (base / "readme.txt").write_text("not data")
    assert ids(readers.read_raw(spark, str(base))) == [30]
    frame.limit(1).toPandas().assign(id=20).to_parquet(base / "b.parquet")
    assert ids(readers.read_raw(spark, str(base))) == [20]
    write_lines(base / "a.jsonl", [{"id": 10}])
    assert ids(readers.read_raw(spark, str(base))) == [10]
    write_lines(base / "a2.json", [{"id": 11}])
    assert ids(readers.read_raw(spark, str(base))) == [10, 11]
    (base / "sub").mkdir()
    write_lines(base / "sub" / "deep.json", [{"id": 12}])
    assert ids(readers.read_raw(spark, str(base))) == [10, 11]


def test_saved_dataset_comes_first(spark, tmp_path):
    saved = str(tmp_path / "s")
    spark.createDataFrame(ROWS).write.parquet(saved)
    write_lines(tmp_path / "s" / "stray.txt")
    assert readers.is_saved_dataset(spark, saved)
    (tmp_path / "s" / "stray.txt").unlink()
    write_lines(tmp_path / "x.json")
    assert ids(readers.read_raw(spark, saved)) == list(range(5))
    with pytest.raises(ValueError, match="not a saved"):
        readers.reload_saved(spark, str(tmp_path))


def test_json_written_by_spark_is_not_a_saved_dataset(spark, tmp_path):
    spark.createDataFrame(ROWS).write.json(str(tmp_path / "j"))
    assert not readers.is_saved_dataset(spark, str(tmp_path / "j"))
    assert ids(readers.read_raw(spark, str(tmp_path / "j"))) == list(range(5))


def test_paths_with_pattern_characters(spark, tmp_path):
    odd = tmp_path / "a[1]{b}*"
    odd.mkdir()
    write_lines(odd / "x.json")
    assert ids(readers.read_raw(spark, str(odd))) == list(range(5))
    assert ids(readers.read_raw(spark, str(odd / "x.json"))) == list(range(5))


def test_source_dispatch(spark, tmp_path):
    saved = str(tmp_path / "s")
    spark.createDataFrame(ROWS).write.parquet(saved)
    for source in ("local", "s3", "huggingface"):
        assert ids(readers.read_source(spark, source, saved)) == list(range(5))
        with pytest.raises(ValueError, match="path"):
            readers.read_source(spark, source)
    with pytest.raises(ValueError, match="unknown"):
        readers.read_source(spark, "ftp", saved)
    with pytest.raises(ValueError, match="not a saved"):
        readers.read_source(spark, "s3", write_lines(tmp_path / "raw.jsonl"))


def test_splits_and_versions(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = [(i, "test" if i % 5 == 0 else "train", "v1" if i < 10 else "v2") for i in range(20)]
    spark.createDataFrame(rows, "id int, split string, version string").write.partitionBy(
        "version", "split"
    ).parquet(table)
    assert ids(readers.read_source(spark, "huggingface", table, "test", revision="v2")) == [10, 15]
    assert ids(readers.read_version(spark, table, "v1")) == list(range(10))
    assert {r["version"] for r in readers.read_version(spark, table, "v1").collect()} == {"v1"}
    with pytest.raises(ValueError, match="v3"):
        readers.read_version(spark, table, "v3")
    plain = str(tmp_path / "plain")
    spark.range(3).write.parquet(plain + "/v2.0")
    assert readers.read_version(spark, plain, "v2.0").count() == 3
    with pytest.raises(ValueError, match="no splits"):
        readers.select_split(spark, plain + "/v2.0", "test")


def test_split_prunes_partitions(spark, tmp_path):
    table = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "if(id < 2, 'test', 'train') split").write.partitionBy("split").parquet(table)
    assert len(readers.select_split(spark, table, "test").inputFiles()) >= 1
    plan = readers.select_split(spark, table, "test")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_prefix(spark, tmp_path):
    base = str(tmp_path / "data")
    for name, value in (("a/x", 1), ("ab/deep/y", 2), ("b/z", 3)):
        spark.createDataFrame([(value,)], "id int").write.parquet(f"{base}/{name}")
    assert ids(landing.read_prefix(spark, f"{base}/a")) == [1, 2]
    assert ids(landing.read_prefix(spark, f"{base}/a/")) == [1]
    assert ids(landing.read_prefix(spark, f"{base}/")) == [1, 2, 3]
    assert landing.read_prefix(spark, f"{base}/none") is None


def test_prefix_leaves_out_its_own_name(spark, tmp_path):
    write_lines(tmp_path / "k", [{"id": 1}])
    write_lines(tmp_path / "k2", [{"id": 2}])
    write_lines(tmp_path / "k.json", [{"id": 3}])
    write_lines(tmp_path / "k2.json", [{"id": 2}])
    with pytest.raises(ValueError, match="k2"):
        landing.read_prefix(spark, str(tmp_path / "k"))
    assert ids(landing.read_prefix(spark, str(tmp_path / "k"), leave_out=["k2"])) == [2, 3]
    assert ids(landing.read_prefix(spark, str(tmp_path / "k."), leave_out=["k2"])) == [3]
    assert ids(landing.read_prefix(spark, str(tmp_path / "k2.json"))or spark.range(0)) == []


def test_s3_settings():
    assert landing.s3_url("b", "data/a") == "s3a://b/data/a"
    with pytest.raises(ValueError):
        landing.s3_url("")
    assert landing.s3_options("b") == {}
    assert landing.s3_options("b", "http://store:9000", "eu-west-1") == {
        "fs.s3a.bucket.b.endpoint": "http://store:9000",
        "fs.s3a.bucket.b.path.style.access": "true",
        "fs.s3a.bucket.b.endpoint.region": "eu-west-1",
    }


def test_land_local(spark, tmp_path):
    source, output = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    first = write_lines(source / "a.json", [{"id": 1}])
    second = write_lines(source / "b.json", [{"id": 2}])
    with pytest.raises(FileNotFoundError):
        landing.land_local(spark, str(tmp_path / "missing"), output)
    landing.land_local(spark, first, output)
    landing.land_local(spark, second, output)
    assert ids(spark.read.parquet(output)) == [1, 2]
    landing.land_local(spark, second, output)
    assert ids(spark.read.parquet(output)) == [1, 2]
    write_lines(source / "b.json", [{"id": 3}])
    landing.land_local(spark, str(source), output)
    assert ids(spark.read.parquet(output)) == [1, 3]


def test_a_tree_of_kinds_lands_whole(spark, tmp_path):
    source, output = tmp_path / "in", str(tmp_path / "out")
    (source / "lang=de" / "deep x+y").mkdir(parents=True)
    (source / "lang=a b+c%").mkdir()
    rows = lambda *ids: spark.createDataFrame([(i, f"t{i}") for i in ids], "id int, text string").toPandas()
    rows(1).to_parquet(source / "top.parquet")
    rows(2, 3).assign(extra=1.5).to_parquet(source / "lang=de" / "deep x+y" / "x.parquet")
    (source / "lang=a b+c%" / "c.csv").write_text("id,text\n4,t4\n")
    (source / "README.md").write_text("about")
    with pytest.raises(ValueError, match="README.md"):
        landing.land_local(spark, str(source), output)
    assert landing.land_local(spark, str(source), output, leave_out=["*.md"]) == 4
    got = {int(r["id"]): (r["lang"], r["extra"]) for r in readers.read_raw(spark, output).collect()}
    assert got == {1: (None, None), 2: ("de", 1.5), 3: ("de", 1.5), 4: ("a b+c%", None)}
    (source / ".hidden.json").write_text('{"id": 9}')
    with pytest.raises(ValueError, match="hidden"):
        landing.land_local(spark, str(source), output, leave_out=["*.md"])


def test_later_files_bring_their_own_columns(spark, tmp_path):
    output = str(tmp_path / "out")
    landing.land_local(spark, write_lines(tmp_path / "p.json", [{"a": 1, "b": 2}]), output)
    landing.land_local(spark, write_lines(tmp_path / "q.json", [{"a": 3, "c": 4}]), output)
    rows = sorted((r["a"], r["b"], r["c"]) for r in readers.read_raw(spark, output).collect())
    assert rows == [(1, 2, None), (3, None, 4)]


def test_a_table_written_as_a_directory_is_added_like_a_file(spark, tmp_path):
    output = str(tmp_path / "out")
    spark.range(2).selectExpr("id a", "'x' b").coalesce(1).write.parquet(str(tmp_path / "one.parquet"))
    spark.range(3).selectExpr("id a", "1.5D c").repartition(3).write.parquet(str(tmp_path / "two.parquet"))
    spark.range(4).selectExpr("id d").repartition(2).write.json(str(tmp_path / "three.json"))
    for _ in range(2):
        for name, rows in (("one.parquet", 2), ("two.parquet", 3), ("three.json/", 4)):
            assert landing.land_local(spark, str(tmp_path / name), output) == rows
    held = readers.read_raw(spark, output).groupBy("landed_from").count()
    assert dict(map(tuple, held.collect())) == {"one.parquet": 2, "two.parquet": 3, "three.json": 4}
    spark.range(5).selectExpr("id a").write.parquet(str(tmp_path / "plain"))
    assert landing.land_local(spark, str(tmp_path / "plain"), output) == 5
    assert readers.read_raw(spark, output).count() == 5


def test_landing_beside_files_that_were_not_landed_is_refused(spark, tmp_path):
    output = str(tmp_path / "out")
    spark.range(10).write.parquet(output)
    with pytest.raises(ValueError, match="beside"):
        landing.land_local(spark, write_lines(tmp_path / "a.json"), output)
    assert spark.read.parquet(output).count() == 10
    with pytest.raises(ValueError, match="landed_from"):
        landing.land_local(spark, write_lines(tmp_path / "b.json", [{"landed_from": 1}]), str(tmp_path / "o"))


def test_prefix_keeps_partition_columns(spark, tmp_path):
    base = str(tmp_path / "data")
    spark.createDataFrame([(1, "a", 7), (2, "ab", 8), (3, None, 9)], "id int, source string, part int").write.partitionBy(
        "source", "part"
    ).parquet(base)
    rows = lambda prefix: sorted(map(tuple, landing.read_prefix(spark, prefix).select("id", "source", "part").collect()))
    assert rows(f"{base}/") == [(1, "a", 7), (2, "ab", 8), (3, None, 9)]
    assert rows(f"{base}/source=a") == [(1, "a", 7), (2, "ab", 8)]
    assert rows(f"{base}/source=a/") == [(1, "a", 7)]


def test_split_slices(spark, tmp_path):
    table = str(tmp_path / "t")
    spark.range(40).selectExpr("id", "if(id < 8, 'test', 'train') split").repartition(3, "id").sortWithinPartitions(
        "id"
    ).write.partitionBy("split").parquet(table)
    whole = {name: [r[0] for r in readers.select_split(spark, table, name).collect()] for name in ("train", "test")}
    chosen = lambda split: sorted(r[0] for r in readers.select_split(spark, table, split).select("id").collect())
    place = "_metadata.file_path", "_metadata.row_index"
    order = {
        name: [r[0] for r in readers.select_split(spark, table, name).select("id", *place).orderBy(*place).collect()] for name in whole
    }
    train = order["train"]
    for text, want in (
        ("train[:5]", train[:5]), ("train[5:9]", train[5:9]), ("train[-3:]", train[-3:]), ("train[:10%]", train[:3]),
        ("train[50%:]", train[16:]), ("train[:-30]", train[:-30]), ("train[30:999]", train[30:]), ("train[9:5]", []),
        ("train[:0]", []), ("train[:]", train), ("train[40:]", []), ("train[:2]+test", train[:2] + order["test"]),
    ):
        assert chosen(text) == sorted(want), text
    for wrong in ("tset", "train[:5", "train[a:b]", "", "train[5]"):
        with pytest.raises(ValueError, match="split"):
            readers.select_split(spark, table, wrong)


def test_a_given_schema_starts_no_inference_job(spark, tmp_path):
    path = write_lines(tmp_path / "a.json")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("no-inference", "x")
    try:
        readers.read_raw(spark, path, readers.Reading(layout="lines", schema="id int"))
        assert not tracker.getJobIdsForGroup("no-inference")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_csv_without_quoted_newlines_can_be_split(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,text\n" + "".join(f"{i},{'x' * 99}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        whole = readers.read_raw(spark, str(path))
        parts = readers.read_raw(spark, str(path), readers.Reading(multi_line=False))
        assert whole.rdd.getNumPartitions() == 1 < parts.rdd.getNumPartitions()
        assert ids(parts) == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_land_once_counts_files_not_directories(spark, tmp_path):
    target, calls = tmp_path / "t", []
    (target / "empty").mkdir(parents=True)
    assert landing.land_once(spark, str(target), lambda: calls.append(1))
    write_lines(target / "empty" / "x.txt")
    assert not landing.land_once(spark, str(target), lambda: calls.append(2))
    (tmp_path / "broken" / "_temporary" / "0").mkdir(parents=True)
    write_lines(tmp_path / "broken" / "_temporary" / "0" / "x.parquet")
    assert landing.land_once(spark, str(tmp_path / "broken"), lambda: calls.append(4))
    calls.pop()
    assert landing.land_once(spark, str(tmp_path / "new"), lambda: calls.append(3))
    assert calls == [1, 3]


def test_landing_report(spark, tmp_path):
    with pytest.raises(RuntimeError, match="nothing lies"):
        landing.landing_report(spark, str(tmp_path / "missing"))
    with pytest.raises(RuntimeError, match="has no files"):
        landing.landing_report(spark, str(tmp_path))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.bin").write_bytes(b"x" * 10)
    (tmp_path / "b.bin").write_bytes(b"y" * 5)
    report = landing.landing_report(spark, str(tmp_path))
    assert tuple(report.first()) == (2, 15)
    (tmp_path / "_hidden").write_bytes(b"z" * 3)
    (tmp_path / "_SUCCESS").touch()
    assert tuple(landing.landing_report(spark, str(tmp_path)).first()) == (3, 18)


def test_landing_counters(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "t"))
    row = landing.landing_counters(spark, str(tmp_path / "t")).first()
    assert row["num_files"] == 3 and row["num_rows"] == 100 and row["num_bytes"] > 0


def test_missing_file(spark, tmp_path):
    with pytest.raises((AnalysisException, Py4JJavaError)):
        readers.read_file(spark, str(tmp_path / "no.parquet"))
