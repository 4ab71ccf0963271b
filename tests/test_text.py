import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions.text import as_text, blank, has_text


def test_blank_agrees_with_strip_on_every_bmp_character(spark):
    points = [i for i in range(0x10000) if not 0xD800 <= i <= 0xDFFF]
    rows = spark.createDataFrame([(i, chr(i)) for i in points], "i int, c string")
    found = {r["i"] for r in rows.filter(blank(F.col("c"))).collect()}
    assert found == {i for i in points if not chr(i).strip()}
    assert len(found) == 29


@pytest.mark.parametrize("text", ["", " ", "\n\t", " ", "　", "\x1c", "  \n"])
def test_blank_strings(spark, text):
    row = spark.range(1).select(blank(F.lit(text)).alias("b"), has_text(F.lit(f"{text}x{text}")).alias("h"))
    assert row.first() == (True, True)


def test_null_is_blank_and_nothing_but_text_is_kept(spark):
    assert spark.range(1).select(blank(F.lit(None).cast("string"))).first()[0] is True
    assert spark.range(1).select(has_text(F.lit("\U0001f600"))).first()[0] is True
    assert spark.range(1).select(has_text(F.lit("​"))).first()[0] is True


def test_as_text(spark):
    df = spark.createDataFrame([(None, None, 7), ("a", True, 8), ("b", False, None)], "s string, b boolean, i int")
    shown = df.select(
        as_text(F.col("s"), T.StringType()),
        as_text(F.col("b"), T.BooleanType()),
        as_text(F.col("i"), T.IntegerType(), "literal"),
    ).collect()
    assert [tuple(r) for r in shown] == [("", "", "7"), ("a", "True", "8"), ("b", "False", "None")]
    with pytest.raises(ValueError):
        as_text(F.col("s"), nulls="drop")


def test_floats_print_as_in_python(spark):
    values = [0.0, -0.0, 1.0, 0.5, -2.25, 100.0, 1e6, 9999999.0, 1e7, -1e7, 12345678.9, 123456789.0, 1e15, 1.5e15,
              123456789012345.6, 9007199254740993.0, 1e16, 1.5e16, -1.25e20, 1e100, 1e300, 0.001, 0.0012, 0.0001,
              -0.00015, 0.00001, 1.5e-05, 1e-10, 2.5e-300, 3e-4, 2e-4, 1.9e-4, float("nan"), float("inf"), -float("inf")]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    shown = [r[0] for r in df.select(as_text(F.col("v"), T.DoubleType())).collect()]
    assert shown == [str(v) for v in values] + [""]


def test_single_precision_prints_widened(spark):
    row = spark.sql("SELECT cast(0.1 AS float) v").select(as_text(F.col("v"), T.FloatType())).first()
    assert row[0] == "0.10000000149011612"
