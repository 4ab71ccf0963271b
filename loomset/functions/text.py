"""Text helpers that follow Python's string rules inside Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 29 code points Python's str.strip() removes.
PYTHON_WHITESPACE = r"\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"

NULL_MODES = ("empty", "literal")


def ref(name: str) -> Column:
    """Reference a top-level column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until the table has no column of that name, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def has_text(col: Column) -> Column:
    """True when Python's ``strip()`` would leave something; null counts as blank.

    Searching for the first non-space character stops there, so long texts cost
    no more than short ones.
    """
    return F.coalesce(col.rlike(f"[^{PYTHON_WHITESPACE}]"), F.lit(False))


def blank(col: Column) -> Column:
    return ~has_text(col)


def as_text(col: Column, dtype: T.DataType | None = None, nulls: str = "empty") -> Column:
    """The string a template prints for a value.

    ``nulls="empty"`` prints nothing for a null, ``nulls="literal"`` prints
    ``None``. Booleans and floats print as Python spells them.
    """
    if nulls not in NULL_MODES:
        raise ValueError(f"nulls must be one of {NULL_MODES}, got {nulls!r}")
    if isinstance(dtype, T.BooleanType):
        col = F.when(col, F.lit("True")).when(~col, F.lit("False"))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        col = _float_text(col.cast("double"))
    elif not isinstance(dtype, T.StringType):
        col = col.cast("string")
    return F.coalesce(col, F.lit("None" if nulls == "literal" else ""))


def _float_text(col: Column) -> Column:
    """Plain digits from 1e-4 up to 1e16, where Spark's cast has them from 1e-3 up to 1e7."""
    shown = col.cast("string")
    pattern = r"^-?(\d)\.(\d+)E(-?\d+)$"
    lead, rest = F.regexp_extract(shown, pattern, 1), F.regexp_extract(shown, pattern, 2)
    rest = F.when(rest == "0", "").otherwise(rest)
    power = F.regexp_extract(shown, pattern, 3).try_cast("int")
    digits = F.concat(lead, rest)

    padded = F.concat(F.rpad(digits, power + 1, F.lit("0")), F.lit(".0"))
    split = F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.lit(20)))
    size = F.abs(power).cast("string")
    exponent = F.concat(
        F.when(power < 0, "e-").otherwise("e+"), F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size)
    )
    unsigned = (
        F.when(power == -4, F.concat(F.lit("0.000"), digits))
        .when(power.between(7, 15) & (F.length(digits) <= power + 1), padded)
        .when(power.between(7, 15), split)
        .otherwise(F.concat(lead, F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), exponent))
    )
    sign = F.when(shown.startswith("-"), "-").otherwise("")
    return (
        F.when(F.isnan(col), "nan")
        .when(shown.endswith("Infinity"), F.concat(sign, F.lit("inf")))
        .when(shown.contains("E"), F.concat(sign, unsigned))
        .otherwise(shown)
    )


def column_text(df: DataFrame, name: str | None, nulls: str = "empty") -> Column:
    """``as_text`` of a named column; a column the table lacks prints nothing."""
    if name is None or name not in df.columns:
        return F.lit("")
    return as_text(ref(name), df.schema[name].dataType, nulls)
