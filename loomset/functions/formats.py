"""The row formats, each a function from a DataFrame to its ``text`` column.

A format looks at the DataFrame only for its schema: which columns exist is
decided once on the driver, the rest is one expression per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions import templates as tpl
from loomset.functions.text import as_text, column_text, has_text, ref

# Alternative names, best first.
USER_COLUMNS = ("instruction", "user", "question")
ASSISTANT_COLUMNS = ("output", "assistant", "answer")
MESSAGE_ROLE_FIELDS = ("from", "role")
MESSAGE_CONTENT_FIELDS = ("value", "content")


def first_present(names: Sequence[str], candidates: Sequence[str]) -> str | None:
    """The first candidate that exists; whether its values are null plays no part."""
    return next((c for c in candidates if c in names), None)


def alpaca(df: DataFrame, variant: str = "preparer", nulls: str = "empty") -> Column:
    if variant == "preparer":
        with_input, plain = tpl.ALPACA_INPUT, tpl.ALPACA_PLAIN
    elif variant == "loader":
        with_input, plain = tpl.LOADER_ALPACA_INPUT, tpl.LOADER_ALPACA_PLAIN
    else:
        raise ValueError(f"unknown Alpaca variant: {variant!r}")
    values = {name: column_text(df, name, nulls) for name in ("instruction", "input", "output")}
    if "input" not in df.columns:
        return tpl.fill(plain, **values)
    return F.when(
        has_text(ref("input").cast("string")), tpl.fill(with_input, **values)
    ).otherwise(tpl.fill(plain, **values))


def message_fields(df: DataFrame, column: str = "conversations") -> T.StructType:
    """The message struct of a conversation column."""
    dtype = df.schema[column].dataType
    if not isinstance(dtype, T.ArrayType) or not isinstance(dtype.elementType, T.StructType):
        raise TypeError(f"{column!r} must be an array of message structs, found {dtype.simpleString()}")
    return dtype.elementType


def _message_value(message: Column, struct: T.StructType, candidates, keys: str) -> Column:
    present = [c for c in candidates if c in struct.names]
    if not present:
        return F.lit("")
    texts = [as_text_or_null(message.getField(c), struct[c].dataType) for c in present]
    return F.coalesce(*texts) if keys == "row" else texts[0]


def as_text_or_null(col: Column, dtype: T.DataType) -> Column:
    return F.when(col.isNotNull(), as_text(col, dtype))


def kept_messages(df: DataFrame, column: str = "conversations", keys: str = "schema") -> Column:
    """The messages whose role is one of the five rendered ones, in order."""
    if keys not in ("schema", "row"):
        raise ValueError(f"keys must be 'schema' or 'row', got {keys!r}")
    struct = message_fields(df, column)
    roles = tpl.SHAREGPT_NAMED_ROLES + tpl.SHAREGPT_ASSISTANT_ROLES
    return F.filter(
        ref(column), lambda m: _message_value(m, struct, MESSAGE_ROLE_FIELDS, keys).isin(*roles)
    )


def sharegpt(
    df: DataFrame, column: str = "conversations", keys: str = "schema", nulls: str = "empty"
) -> Column:
    """One block per message, in order; no messages give an empty text.

    ``keys="schema"`` picks the spelling of the message fields once for the
    whole table, as a table that has both ``from`` and ``role`` is read by
    ``from`` alone. ``keys="row"`` falls through to the other spelling where
    the first is null.
    """
    if column not in df.columns:
        return F.lit("")
    struct = message_fields(df, column)

    def block(m: Column) -> Column:
        role = _message_value(m, struct, MESSAGE_ROLE_FIELDS, keys)
        content = _message_value(m, struct, MESSAGE_CONTENT_FIELDS, keys)
        heading = F.when(role.isin(*tpl.SHAREGPT_ASSISTANT_ROLES), F.lit("### Assistant:\n"))
        for name in tpl.SHAREGPT_NAMED_ROLES:
            heading = heading.when(role == name, F.lit(f"### {name.capitalize()}:\n"))
        # Null for any other role, and joining leaves nulls out.
        return F.concat(heading, as_text(content, T.StringType(), nulls))

    blocks = F.transform(ref(column), block)
    return F.coalesce(F.array_join(blocks, tpl.SHAREGPT_SEPARATOR), F.lit(""))


def chat_roles(df: DataFrame, system_msg: str | None = None, nulls: str = "empty") -> dict[str, Column]:
    """Where the system, user and assistant parts of a chat row come from.

    A ``system`` column beats the argument; an empty argument means the default.
    """
    if "system" in df.columns:
        system = column_text(df, "system", nulls)
    else:
        system = F.lit(system_msg or tpl.DEFAULT_SYSTEM)
    return {
        "system": system,
        "user": column_text(df, first_present(df.columns, USER_COLUMNS), nulls),
        "assistant": column_text(df, first_present(df.columns, ASSISTANT_COLUMNS), nulls),
    }


def chatml(df: DataFrame, system_msg: str | None = None, nulls: str = "empty") -> Column:
    return tpl.fill(tpl.CHATML, **chat_roles(df, system_msg, nulls))


def llama(df: DataFrame, system_msg: str | None = None, nulls: str = "empty") -> Column:
    return tpl.fill(tpl.LLAMA, **chat_roles(df, system_msg, nulls))


def custom(
    df: DataFrame,
    instruction_col: str = "instruction",
    response_col: str = "output",
    input_col: str | None = None,
    system_msg: str | None = None,
    nulls: str = "empty",
    strict: bool = False,
) -> Column:
    """Named columns into sections; the context section only where it has text.

    A named column that does not exist prints nothing; ``strict=True`` raises
    instead, since such rows still carry the headings and are never dropped as
    empty.
    """
    named = [instruction_col, response_col] + ([input_col] if input_col else [])
    missing = [c for c in named if c not in df.columns]
    if strict and missing:
        raise ValueError(f"columns not found: {missing}; the table has {df.columns}")
    values = {
        "system": F.lit(system_msg or tpl.DEFAULT_SYSTEM),
        "instruction": column_text(df, instruction_col, nulls),
        "response": column_text(df, response_col, nulls),
    }
    plain = tpl.fill(tpl.CUSTOM_PLAIN, **values)
    if not input_col or input_col not in df.columns:
        return plain
    context = column_text(df, input_col, nulls)
    return F.when(
        has_text(ref(input_col).cast("string")), tpl.fill(tpl.CUSTOM_CONTEXT, context=context, **values)
    ).otherwise(plain)
