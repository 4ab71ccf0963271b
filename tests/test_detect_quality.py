import pytest
from pyspark.sql import functions as F

from loomset.operators import detect, quality
from loomset.operators.lengths import token_cap, tokenizer_file
from loomset.sources.readers import read_raw

from plans import plan_of


def test_text_field_choice(spark):
    def field(schema, **options):
        return detect.resolve_text_field(spark.createDataFrame([], schema), **options)

    assert field("instruction string, output string, body string", configured="body") == "text"
    assert field("id int, text string", configured="id") == "text"
    assert field("id int, body string", configured="body") == "body"
    assert field("id int, body string") == "id"
    assert field("id int, body string", first_string=True) == "body"
    with pytest.raises(ValueError):
        field("id int", first_string=True)


def test_autodetect_overwrites_alpaca_text_only(spark):
    alpaca = spark.createDataFrame([("i", "o", "old")], "instruction string, output string, text string")
    assert detect.autodetect(alpaca).first()["text"].endswith("### Response:\no")
    plain = spark.createDataFrame([("i", "old")], "instruction string, text string")
    assert detect.autodetect(plain).first()["text"] == "old"


def test_training_projection_reads_only_the_text(spark, sf_dir):
    df = detect.training_projection(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert df.columns == ["text"]
    assert "ReadSchema: struct<text:string>" in plan_of(df)


def test_drop_empty_and_report(spark):
    df = spark.createDataFrame([("a",), (" ",), ("",), (None,), ("　",), (" b ",)], "text string")
    assert [r["text"] for r in quality.drop_empty(df).collect()] == ["a", " b "]
    assert tuple(quality.filter_report(df).first()) == (6, 2)
    assert quality.count_rows(df).first()["num_rows"] == 6


def test_require_rows(spark):
    df = spark.createDataFrame([(" ",)], "text string")
    assert quality.require_rows(df) is df
    with pytest.raises(ValueError, match="empty"):
        quality.require_rows(quality.drop_empty(df))


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """Numbers 0..99 in order over several files, as Parquet and as JSON lines."""
    base = tmp_path_factory.mktemp("ordered")
    numbers = spark.range(100).selectExpr("id", "concat('t', id) text").coalesce(1).sortWithinPartitions("id")
    for kind in ("parquet", "json"):
        for start in range(0, 100, 30):
            part = numbers.filter((F.col("id") >= start) & (F.col("id") < start + 30))
            getattr(part.coalesce(1).write, kind)(f"{base}/{kind}/{start:03d}")
    return base


@pytest.mark.parametrize("kind", ["parquet", "json"])
@pytest.mark.parametrize("n", [None, 1, 30, 31, 75, 100, 1000])
def test_first_n_follows_the_files(spark, many_files, kind, n):
    df = spark.read.option("recursiveFileLookup", True).format(kind).load(f"{many_files}/{kind}")
    got = sorted(r["id"] for r in quality.first_n(df, n).collect())
    assert got == list(range(min(n or 100, 100)))


@pytest.mark.parametrize("n", [0, 1, 5, 99, 500])
def test_first_n_by_key(spark, n):
    rows = [(i // 10, i % 10) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = sorted(tuple(r) for r in quality.first_n(df, n, ["a", "b"]).collect())
    assert got == rows[: n or 100]


def test_first_n_by_key_with_nulls_first(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,)], "a int")
    assert sorted([r["a"] for r in quality.first_n(df, 2, "a").collect()], key=str) == [1, None]
    assert [r["a"] for r in quality.first_n(df, 1, "a").collect()] == [None]


def test_first_n_by_key_reaches_the_scan(spark, many_files):
    df = spark.read.option("recursiveFileLookup", True).parquet(f"{many_files}/parquet")
    plan = plan_of(quality.first_n(df, 5, "id"))
    assert "LessThanOrEqual(id,4)" in plan and "Exchange" not in plan


@pytest.mark.parametrize("n", [1, 7, 1999, 2000])
def test_first_n_of_one_split_json_file(spark, tmp_path, n):
    path = tmp_path / "a.jsonl"
    path.write_text("".join('{"id": %d}\n' % i for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        df = spark.read.json(str(path))
        assert df.rdd.getNumPartitions() > 5
        assert sorted(r["id"] for r in quality.first_n(df, n).collect()) == list(range(n))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_first_n_counts_what_a_filter_leaves(spark, many_files):
    df = spark.read.option("recursiveFileLookup", True).parquet(f"{many_files}/parquet").filter("id % 2 = 0")
    assert sorted(r["id"] for r in quality.first_n(df, 10).collect()) == list(range(0, 20, 2))
    assert sorted(r["id"] for r in quality.first_n(df, 31).collect()) == list(range(0, 62, 2))
    lines = spark.read.option("recursiveFileLookup", True).json(f"{many_files}/json").filter("id % 2 = 0")
    assert sorted(r["id"] for r in quality.first_n(lines, 31).collect()) == list(range(0, 62, 2))


def test_first_n_breaks_ties_by_place(spark, many_files):
    df = spark.read.option("recursiveFileLookup", True).parquet(f"{many_files}/parquet")
    tens = df.withColumn("ten", F.floor(F.col("id") / 10) % 2)
    got = sorted(r["id"] for r in quality.first_n(tens, 12, "ten").collect())
    assert got == [*range(10), 20, 21]
    with pytest.raises(ValueError, match="share"):
        quality.first_n(spark.range(50).selectExpr("id % 2 as b"), 10, "b")


def test_first_n_rejects_negative(spark):
    with pytest.raises(ValueError):
        quality.first_n(spark.range(3), -1)


def test_first_n_needs_a_key_away_from_files(spark):
    with pytest.raises(ValueError, match="key"):
        quality.first_n(spark.range(3), 1)
    assert quality.first_n(spark.range(3), 2, "id").count() == 2


def test_first_n_of_parquet_moves_no_rows(spark, many_files):
    df = spark.read.option("recursiveFileLookup", True).parquet(f"{many_files}/parquet")
    assert "Exchange" not in plan_of(quality.first_n(df, 50))


def test_preview_is_the_start_of_the_first_text(spark):
    df = spark.createDataFrame([(2, "b"), (1, "x" * 700)], "id int, text string")
    assert quality.preview(df, "id").first()["preview"] == "x" * 500


def test_token_cap(spark):
    df = spark.createDataFrame([(1, "a b  c\nd"), (2, ""), (3, None), (4, "x y")], "id int, text string")
    got = {r["id"]: (r["tokens"], r["n_tokens"], r["truncated"]) for r in token_cap(df, 3).collect()}
    assert got == {
        1: (["a", "b", "c"], 4, True),
        2: ([], 0, False),
        3: ([], 0, False),
        4: (["x", "y"], 2, False),
    }


def test_token_cap_with_a_given_tokenizer(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, "e")], "id int, text string")

    def characters():
        return lambda text: [ord(c) for c in text]

    out = token_cap(df, 2, make_tokenizer=characters, token_type="long")
    got = {r["id"]: (r["tokens"], r["n_tokens"], r["truncated"]) for r in out.collect()}
    assert got == {1: ([97, 98], 4, True), 2: ([101], 1, False)}


def test_token_cap_with_a_tokenizer_file(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    model = tokenizers.models.WordLevel({"[UNK]": 0, "a": 1, "b": 2}, unk_token="[UNK]")
    made = tokenizers.Tokenizer(model)
    made.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    path = str(tmp_path / "tokenizer.json")
    made.save(path)
    df = spark.createDataFrame([(1, "a b c a"), (2, "")], "id int, text string")
    out = token_cap(df, 3, make_tokenizer=tokenizer_file(path), token_type="long")
    got = {r["id"]: (r["tokens"], r["n_tokens"], r["truncated"]) for r in out.collect()}
    assert got == {1: ([1, 2, 0], 4, True), 2: ([], 0, False)}


@pytest.mark.parametrize("name, body", [
    ("a.json", '{"id": 0}\n\n{"id": 1}\n\n\n{"id": 2}\n{"id": 3}\n'),
    ("a.json", '[{"id": 0},\n\n {"id": 1}, {"id": 2},\n{"id": 3}]'),
    ("a.csv", 'id,t\n0,"x\n\ny"\n\n1,b\n\n\n2,c\n3,d\n'),
])
@pytest.mark.parametrize("n", [1, 2, 3, 4, 9])
def test_first_n_does_not_count_blank_lines(spark, tmp_path, name, body, n):
    (tmp_path / name).write_text(body)
    rows = quality.first_n(read_raw(spark, str(tmp_path / name)), n)
    assert sorted(int(r["id"]) for r in rows.collect()) == list(range(min(n, 4)))
