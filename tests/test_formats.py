"""Golden texts and odd rows for each format."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomset.functions import formats
from loomset.operators.render import FORMATS, filter_rows, map_rows, render
from loomset.plans.preparation import prepared_rows

from plans import plan_of

ALPACA_SCHEMA = "instruction string, input string, output string"


def texts(df):
    return [r["text"] for r in df.select("text").collect()]


def one(spark, row, schema, format, **options):
    return texts(render(spark.createDataFrame([row], schema), format, **options))[0]


def test_alpaca_with_and_without_input(spark):
    assert one(spark, ("Add", "1 2", "3"), ALPACA_SCHEMA, "alpaca") == (
        "Below is an instruction that describes a task, paired with an input that provides further "
        "context. Write a response that appropriately completes the request.\n\n"
        "### Instruction:\nAdd\n\n### Input:\n1 2\n\n### Response:\n3"
    )
    assert one(spark, ("Add", "", "3"), ALPACA_SCHEMA, "alpaca") == (
        "Below is an instruction that describes a task. Write a response that appropriately completes "
        "the request.\n\n### Instruction:\nAdd\n\n### Response:\n3"
    )


def test_alpaca_loader_has_its_own_wording(spark):
    assert one(spark, ("Add", "1 2", "3"), ALPACA_SCHEMA, "alpaca", variant="loader") == (
        "Below is an instruction that describes a task, paired with an input that provides     further "
        "context. Write a response that appropriately completes the request.\n\n"
        "### Instruction:\nAdd\n\n### Input:\n1 2\n\n### Response:\n3"
    )
    assert one(spark, ("Add", " ", "3"), ALPACA_SCHEMA, "alpaca", variant="loader") == (
        "Below is an instruction that describes a task. Write a response that appropriately     completes "
        "the request.\n\n### Instruction:\nAdd\n\n### Response:\n3"
    )
    with pytest.raises(ValueError):
        one(spark, ("a", "b", "c"), ALPACA_SCHEMA, "alpaca", variant="other")


@pytest.mark.parametrize("context", [None, "", " ", "\n\t", " ", "　", "\x1c"])
def test_blank_context_has_no_section(spark, context):
    assert "### Input:" not in one(spark, ("i", context, "o"), ALPACA_SCHEMA, "alpaca")
    named = dict(instruction_col="instruction", response_col="output", input_col="input")
    assert "### Context:" not in one(spark, ("i", context, "o"), ALPACA_SCHEMA, "custom", **named)


def test_context_keeps_its_surrounding_space(spark):
    assert "### Input:\n x \n\n###" in one(spark, ("i", " x ", "o"), ALPACA_SCHEMA, "alpaca")


@pytest.mark.parametrize("data", ["{}", "{instruction}", "$1", "\\\\", "%s", "\\n", "'\"", "\U0001f600"])
def test_data_is_never_interpreted(spark, data):
    for name in ("alpaca", "chatml", "llama", "custom"):
        assert one(spark, (data, data, data), ALPACA_SCHEMA, name).count(data) >= 2
    message = [{"from": "human", "value": data}]
    assert one(spark, (message,), "conversations array<struct<from:string,value:string>>", "sharegpt") == (
        "### Human:\n" + data
    )


def test_missing_columns_print_nothing(spark):
    assert one(spark, ("i",), "instruction string", "alpaca").endswith("### Instruction:\ni\n\n### Response:\n")
    assert one(spark, ("x",), "other string", "chatml").endswith("<|im_start|>assistant\n<|im_end|>")
    assert one(spark, ("x",), "other string", "sharegpt") == ""


def test_null_values(spark):
    empty = one(spark, (None, "c", None), ALPACA_SCHEMA, "alpaca")
    assert empty.endswith("### Instruction:\n\n\n### Input:\nc\n\n### Response:\n")
    literal = one(spark, (None, None, None), ALPACA_SCHEMA, "alpaca", nulls="literal")
    assert literal.endswith("### Instruction:\nNone\n\n### Response:\nNone")


def test_numbers_and_booleans(spark):
    assert one(spark, (3, "", True), "instruction int, input string, output boolean", "alpaca").endswith(
        "### Instruction:\n3\n\n### Response:\nTrue"
    )


FROM_VALUE = "conversations array<struct<from:string,value:string>>"
ROLE_CONTENT = "conversations array<struct<role:string,content:string>>"
BOTH = "conversations array<struct<from:string,value:string,role:string,content:string>>"


def test_sharegpt_roles(spark):
    talk = [
        {"from": "system", "value": "be kind"},
        {"from": "human", "value": "hi"},
        {"from": "gpt", "value": "hello"},
        {"from": "tool", "value": "dropped"},
        {"from": "User", "value": "dropped too"},
        {"from": "user", "value": "bye"},
        {"from": "assistant", "value": ""},
        {"from": None, "value": "no role"},
    ]
    assert one(spark, (talk,), FROM_VALUE, "sharegpt") == (
        "### System:\nbe kind\n\n### Human:\nhi\n\n### Assistant:\nhello\n\n### User:\nbye\n\n### Assistant:\n"
    )


def test_sharegpt_other_spelling(spark):
    talk = [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]
    assert one(spark, (talk,), ROLE_CONTENT, "sharegpt") == "### User:\nq\n\n### Assistant:\n"
    assert one(spark, (talk,), ROLE_CONTENT, "sharegpt", nulls="literal").endswith("### Assistant:\nNone")


def test_sharegpt_with_both_spellings_in_one_table(spark):
    talk = [
        {"from": "human", "value": "a", "role": None, "content": None},
        {"from": None, "value": None, "role": "assistant", "content": "b"},
    ]
    assert one(spark, (talk,), BOTH, "sharegpt") == "### Human:\na"
    assert one(spark, (talk,), BOTH, "sharegpt", keys="row") == "### Human:\na\n\n### Assistant:\nb"


def test_sharegpt_without_messages(spark):
    for talk in (None, [], [{"from": "tool", "value": "x"}], [None]):
        assert one(spark, (talk,), FROM_VALUE, "sharegpt") == ""
    with pytest.raises(TypeError):
        one(spark, ("x",), "conversations string", "sharegpt")


def test_chatml(spark):
    assert one(spark, ("s", "q", "a"), "system string, user string, assistant string", "chatml") == (
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>"
    )


def test_llama(spark):
    assert one(spark, ("q", "a"), "question string, answer string", "llama") == (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nYou are a helpful assistant.<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\nq<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\na<|eot_id|>"
    )


def test_system_column_beats_argument_and_empty_argument_is_default(spark):
    schema = "system string, instruction string, output string"
    assert "system\nfrom column<" in one(spark, ("from column", "q", "a"), schema, "chatml", system_msg="arg")
    plain = "instruction string, output string"
    assert "system\narg<" in one(spark, ("q", "a"), plain, "chatml", system_msg="arg")
    assert "system\nYou are a helpful assistant.<" in one(spark, ("q", "a"), plain, "chatml", system_msg="")


def test_first_existing_role_column_wins_even_if_null(spark):
    schema = "question string, user string, instruction string, answer string, output string"
    text = one(spark, ("q", "u", None, "a", None), schema, "chatml")
    assert "user\n<|im_end|>" in text and "assistant\n<|im_end|>" in text


def test_alpaca_input_is_not_used_by_chat_formats(spark):
    for name in ("chatml", "llama"):
        assert "secret" not in one(spark, ("i", "secret", "o"), ALPACA_SCHEMA, name)


def test_custom(spark):
    schema = "question string, answer string, context string, system string"
    named = dict(instruction_col="question", response_col="answer", input_col="context")
    assert one(spark, ("q", "a", "c", "ignored"), schema, "custom", system_msg="s", **named) == (
        "### System:\ns\n\n### Instruction:\nq\n\n### Context:\nc\n\n### Response:\na"
    )
    assert one(spark, ("q", "a", "c", "ignored"), schema, "custom", **{**named, "input_col": None}) == (
        "### System:\nYou are a helpful assistant.\n\n### Instruction:\nq\n\n### Response:\na"
    )


def test_custom_missing_column(spark):
    wrong = dict(instruction_col="nope", response_col="answer")
    assert "### Instruction:\n\n\n" in one(spark, ("a",), "answer string", "custom", **wrong)
    with pytest.raises(ValueError, match="nope"):
        one(spark, ("a",), "answer string", "custom", strict=True, **wrong)


def test_odd_column_names(spark):
    schema = "`a.b` string, `c``d` string"
    named = dict(instruction_col="a.b", response_col="c`d")
    assert one(spark, ("q", "a"), schema, "custom", **named).endswith("### Instruction:\nq\n\n### Response:\na")


def test_dispatch(spark):
    assert set(FORMATS) == {"alpaca", "sharegpt", "chatml", "llama", "custom"}
    df = spark.createDataFrame([("i", "c", "o")], ALPACA_SCHEMA)
    with pytest.raises(ValueError, match="format"):
        render(df, "vicuna")
    shout = render(df, lambda d: F.upper("output"))
    assert shout.columns == ["instruction", "input", "output", "text"] and texts(shout) == ["O"]


def test_render_overwrites_text_in_place_and_keeps_the_rest(spark):
    df = spark.createDataFrame([("old", "i", "o")], "text string, instruction string, output string")
    out = render(df, "chatml")
    assert out.columns == ["text", "instruction", "output"] and "old" not in texts(out)[0]


def test_column_names_differ_by_case(spark):
    df = spark.createDataFrame([("kept", "i", "o")], "Text string, instruction string, output string")
    out = render(df, "chatml")
    assert out.columns == ["Text", "instruction", "output", "text"]
    assert out.first()["Text"] == "kept" and prepared_rows(df, lambda d: F.col("output")).count() == 1
    assert one(spark, ("I", "o"), "Instruction string, output string", "alpaca").endswith("Instruction:\n\n\n### Response:\no")


def test_builtin_formats_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("i", "c", "o", [("human", "x")])],
                               ALPACA_SCHEMA + ", conversations array<struct<from:string,value:string>>")
    for name in FORMATS:
        plan = plan_of(render(df, name))
        assert "Python" not in plan and "MapInArrow" not in plan and "Exchange" not in plan


def test_kept_messages(spark):
    df = spark.createDataFrame([([{"from": "human", "value": "x"}, {"from": "tool", "value": "y"}],)], FROM_VALUE)
    assert [m["value"] for m in df.select(formats.kept_messages(df)).first()[0]] == ["x"]
    with pytest.raises(ValueError):
        formats.kept_messages(df, keys="both")


def test_python_row_function(spark):
    df = spark.createDataFrame([(1, "a", [1, 2]), (2, None, None)], "i int, s string, l array<int>")

    def fn(row):
        return {"text": f"{row['s']}/{row['l']}", "n": row["i"] * 2}

    out = map_rows(df, fn, {"text": "string", "n": "long"})
    assert out.columns == ["i", "s", "l", "text", "n"]
    assert plan_of(out).count("apply(") == 1
    assert [tuple(r) for r in out.orderBy("i").collect()] == [
        (1, "a", [1, 2], "a/[1, 2]", 2),
        (2, None, None, "None/None", 4),
    ]
    with pytest.raises(ValueError):
        map_rows(df, fn, {"text": "varchar"})


def test_python_row_function_sees_the_named_columns(spark):
    df = spark.createDataFrame([(1, "a", "old", [("human", "x")])],
                               "i int, s string, text string, m array<struct<from:string,value:string>>")
    out = map_rows(df, lambda r: {"text": f"{sorted(r)} {r['m'][0]['value']}"}, columns=["s", "m"])
    assert out.columns == ["i", "s", "m", "text"]
    assert out.first()["text"] == "['m', 's'] x"
    assert filter_rows(df, lambda r: sorted(r) == ["i"], columns=["i"]).count() == 1


def test_python_row_function_over_more_tasks(spark):
    df = spark.range(20).coalesce(1)
    out = map_rows(df, lambda r: {"text": str(r["id"])}, partitions=3)
    assert out.rdd.getNumPartitions() == 3
    assert sorted(int(t) for t in texts(out)) == list(range(20))


def test_only_formats_that_can_be_blank_are_filtered(spark):
    df = spark.createDataFrame([("i", "c", "o", [("human", "x")])],
                               ALPACA_SCHEMA + ", conversations array<struct<from:string,value:string>>")
    for name in FORMATS:
        assert ("Filter" in plan_of(prepared_rows(df, name))) == (name == "sharegpt")
    assert "Filter" not in plan_of(prepared_rows(df, "sharegpt", keep_empty=True))
    assert "Filter" in plan_of(prepared_rows(df, lambda d: F.col("input")))


ROLES = ("system", "human", "user", "gpt", "assistant", "tool", "User", "", None)
HEADINGS = {"system": "System", "human": "Human", "user": "User", "gpt": "Assistant", "assistant": "Assistant"}
TALKS = st.lists(
    st.one_of(
        st.none(),
        st.lists(st.tuples(st.sampled_from(ROLES), st.one_of(st.none(), st.text(max_size=5))), max_size=6),
    ),
    min_size=1,
    max_size=20,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(talks=TALKS)
def test_sharegpt_against_brute_force(spark, talks):
    talks = [
        t if t is None else [(r, v if v is None else v.encode("utf8", "ignore").decode()) for r, v in t]
        for t in talks
    ]
    df = spark.createDataFrame(list(enumerate(talks)), "id int, " + FROM_VALUE)
    want = {
        i: "\n\n".join(f"### {HEADINGS[r]}:\n{v or ''}" for r, v in talk or [] if r in HEADINGS)
        for i, talk in enumerate(talks)
    }
    assert {r["id"]: r["text"] for r in render(df, "sharegpt").collect()} == want


def test_python_filter(spark):
    df = spark.createDataFrame([(i, "x" * (i % 3)) for i in range(100)], "i int, s string")
    kept = filter_rows(df, lambda r: len(r["s"].strip()) > 0)
    assert kept.columns == df.columns
    assert kept.count() == df.filter(F.length("s") > 0).count() == filter_rows(df, F.length("s") > 0).count()
